"""Registered queries against their SQL on the smallest tables."""

import os

import pytest
from rig import compare, connect

import __spark_entry__ as entry

FOLDER = os.environ.get("TALLYFLOW_TEST_DATA", "/root/testdata/sf0.001")
SAMPLE = (
    "JOB1_flatten_events", "JOB2_rate_model_fixed_prior", "JOB4_separation_test", "JOB6_segment_dataset",
    "JN14_fallback_lookup", "AG20_summary", "SIM4_similar_pairs", "EV2_weighted_roc_auc", "SPL3_chronological_split",
    "WN4_frontier", "FE13_without_preinstalled", "SNK1_partitioned_parquet",
)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(FOLDER):
        pytest.skip("test tables are not here")
    return connect(FOLDER)


def test_every_check_names_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, duck, name):
    rows, problem = compare(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name])
    assert problem is None, problem
