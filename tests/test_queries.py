"""Every registered query against its SQL, plain and with forced small blocks."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from sensorloom.session import ROWS_PER_BLOCK

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()

# Queries whose plans use ordered scans.
SCANNED = """nearest_cutoff stereo_zip approx_sync interp_linear interp_match_topic thin_min_gap monotone_filter path_length rle_keys
masked_scatter cloud_cap running_history interp_series positional_join first_n stride_sample interp_pose rank_clip depth_percentile
frame_numbers transform_at stream_thin reindex interp_modes stamp_files export_dataset adaptive_clip stream_ticks""".split()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    problem = compare(spark, con, FOLDER, name, QUERIES[name], SQL.get(name))
    assert problem in ("", "both empty")


@pytest.mark.parametrize("name", SCANNED)
def test_query_in_small_blocks(spark, con, name):
    spark.conf.set(ROWS_PER_BLOCK, "60")
    try:
        assert compare(spark, con, FOLDER, name, QUERIES[name], SQL[name]) in ("", "both empty")
    finally:
        spark.conf.unset(ROWS_PER_BLOCK)


def test_entry(spark):
    rows = entry(spark)
    assert set(rows.columns) == {"topic", "idx", "target", "match", "err"} and not rows.isEmpty()


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
