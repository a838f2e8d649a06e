"""A part of the catalog against its SQL in DuckDB, over the smallest given tables if they are there."""

from __future__ import annotations

import os

import pandas as pd
import pytest

from gridloom import catalog

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
NAMES = ("R01_hourly_rollup", "R01_hourly_rollup_dst", "A01_daily_kwh", "A09_coverage_matrix", "W06_frozen_runs", "W08_hole_runs", "A33_priced_lines", "I06_panel_payload", "I11_espi_intervals", "Q05_compare_meter", "K03_regenerate_days", "I02_tolerant_hourly", "I04_read_daily", "I12_usage_csv", "Q17_import_meter", "J06_absent_hours", "A15_meter_groups", "Q20_layout_changes", "Q02_findings", "ST03_hourly_windows", "ST05_touched_days", "ST06_merge_deltas", "ST10_sync_rule", "K01_closed_hours", "K02_compaction", "K04_month_upsert", "K06_verified_write", "K09_catalog", "W02_deltas", "W04_gaps", "W12_zero_runs")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("region", "orders", "events"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = catalog.QUERIES[name](spark, DATA).toPandas(), db.execute(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(tuple("" if pd.isna(x) else f"{float(x):.7f}" if isinstance(x, (int, float)) else str(x).replace(" 00:00:00", "") for x in r) for r in df[sorted(df.columns)].astype(object).values.tolist())
    assert rows(got) == rows(want)


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
