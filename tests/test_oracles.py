"""Queries against their oracle SQL on the smallest tables. GAUGELINE_ALL=1 runs every one."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import oracle_connection, rows_of

SF = "/root/testdata/sf0.001"
CORE = {
    "A01_csv_reader", "A03_unpack_payload", "A06_incremental_append", "A13_prediction_store", "B02_calendar_parts",
    "B06_quality_score", "B20_threshold_table", "C03_star_join", "D01_daily_rollup", "D01_daily_rollup_long",
    "D09_describe", "D17_pivot_temperature", "D20_exact_quantiles_by_position", "D21_extreme_days", "D22_histogram",
    "D25_correlation_matrix", "E04_gap_fill", "E04_gap_fill_in_blocks", "E08_feature_mart_long",
    "E08_feature_mart_in_blocks", "E12_average_ranks", "H02_date_dimension", "I09_continuous_days", "I10_consistent_lag",
    "J01_dagostino", "J05_t_test", "J06_mann_whitney", "J09_kruskal", "J14_kendall", "J16_chi_square", "K03_time_split",
    "K06_last_value_baseline", "L01_distinct_stream", "L02_daily_stream",
}
NAMES = sorted(oracle_sql() if os.environ.get("GAUGELINE_ALL") else CORE)


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    cursor = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 150 and df.columns[0] == "daily_id"
