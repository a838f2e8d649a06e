"""Equipment state against measured power, on buckets: two sources never share an instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_W_PER_POINT = 29.9


def pearson(x: str, y: str) -> Column:
    """Correlation over rows that have both; null where a side is flat or there are fewer than three pairs."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return F.when((F.count(a) >= 3) & (F.stddev_pop(a) > 1e-12) & (F.stddev_pop(b) > 1e-12), r)


def agreement(pairs: DataFrame) -> DataFrame:
    """One row over (capacity, watts): number, correlation, watts a point with its spread, implied full load."""
    p = pairs.where("capacity > 0 AND watts IS NOT NULL").withColumn("per_point", F.col("watts") / F.col("capacity"))
    return p.agg(F.count("*").alias("n"), pearson("capacity", "watts").alias("r"), F.avg("per_point").alias("w_per_point"), F.stddev_pop("per_point").alias("sd"), (F.avg("per_point") * 100).alias("full_load_w"))


def capacity_bands(pairs: DataFrame, width: int = 5) -> DataFrame:
    p = pairs.where("capacity > 0")
    return p.groupBy((F.bround(F.col("capacity") / width) * width).cast("int").alias("band")).agg(F.count("*").alias("n"), F.avg("watts").alias("mean_w"), F.min("watts").alias("min_w"), F.max("watts").alias("max_w"))


def off_state(pairs: DataFrame, idle_w: float = 25.0) -> DataFrame:
    """How off and running states sit with power; every state but off and idle runs."""
    running = ~F.col("state").isin("off", "idle")
    return pairs.agg(
        F.count_if(~running & (F.col("watts") <= idle_w)).alias("off_quiet"), F.count_if(~running & (F.col("watts") > idle_w)).alias("off_drawing"), F.count_if(running & (F.col("watts") > idle_w)).alias("on_drawing"),
        F.count_if(running & (F.col("watts") <= idle_w)).alias("on_quiet"), F.max(F.when(~running, F.col("watts"))).alias("off_max_w"), F.avg(F.when(running, F.col("watts"))).alias("on_mean_w"),
    )


def feeder_profile(pairs: DataFrame, speed: str = "rpm") -> DataFrame:
    """Correlation of watts with speed, its cube, air flow and capacity."""
    return pairs.withColumn("cube", F.pow(F.col(speed), 3)).agg(F.count("*").alias("n"), pearson(speed, "watts").alias("r_speed"), pearson("cube", "watts").alias("r_cube"), pearson("cfm", "watts").alias("r_cfm"), pearson("capacity", "watts").alias("r_capacity"))


def speed_bands(pairs: DataFrame, speed: str = "rpm", width: int = 200) -> DataFrame:
    return pairs.groupBy((F.floor(F.col(speed) / width) * width).cast("long").alias("band")).agg(F.count("*").alias("n"), F.avg("watts").alias("mean_w"))


def modelled(pairs: DataFrame, least: int = 30) -> DataFrame:
    """Capacity times watts a point (fitted if enough pairs), and the residual; derived, never stored."""
    fit = agreement(pairs).select(F.when(F.col("n") >= least, F.col("w_per_point")).otherwise(F.lit(DEFAULT_W_PER_POINT)).alias("coefficient"))  # one row
    return pairs.crossJoin(F.broadcast(fit)).withColumn("modelled_w", F.col("capacity") * F.col("coefficient")).withColumn("residual_w", F.col("watts") - F.col("modelled_w"))


def state_vs_power(states: DataFrame, power: DataFrame) -> DataFrame:
    """Bucketed states with the bucket's power where there is any."""
    return states.join(power, "bucket", "left")


def component_vs_panel(component: DataFrame, panel: DataFrame, channels: int, least: float = 0.95) -> DataFrame:
    """Day energies side by side; a delta only where all channels reported and coverage suffices."""
    both = component.join(panel, "local_day", "full_outer")
    ok = (F.col("channels") == channels) & (F.col("coverage") >= least)
    return both.withColumn("delta_kwh", F.when(ok, F.col("panel_kwh") - F.col("kwh")))


def latch_verdicts(pairs: DataFrame) -> DataFrame:
    """Verdict classes of paired samples, how many, and their ages."""
    verdict = F.when(F.col("a").isNull() | F.col("b").isNull(), "one side only").when(F.col("a") == F.col("b"), "equal").when(F.abs(F.col("a") - F.col("b")) <= 0.05 * F.abs(F.col("a")), "close").otherwise("different")
    return pairs.withColumn("verdict", verdict).groupBy("verdict").agg(F.count("*").alias("n"), F.median("age_s").alias("median_age_s"), F.max("age_s").alias("max_age_s"))
