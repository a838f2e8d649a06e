"""Registration of queries over the views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..views import Views, sql


def rounded(df: DataFrame, digits: int = 7) -> DataFrame:
    """Doubles to a coarse scale, so that the order of floating sums doesn't show."""
    return df.select(*(F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`") for f in df.schema))


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Views], DataFrame], views: str = "", body: str | None = None, digits: int = 7, doubles: str = "") -> None:
        """``build`` makes the frame; ``body`` is its SQL over ``views``, ``doubles`` the columns to round there."""
        self.queries[name] = lambda spark, sf_dir: rounded(build(Views(spark, sf_dir)), digits)
        if body is not None:
            text = sql(views, body) if views else body
            if doubles:
                text = f"SELECT * REPLACE ({', '.join(f'round(CAST({c} AS DOUBLE), {digits}) AS {c}' for c in doubles.split())}) FROM ({text})"
            self.oracles[name] = text
