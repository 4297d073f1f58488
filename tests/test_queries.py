"""The catalogue: completeness, and a cross-section of queries against the check engine."""

import pytest

import __spark_entry__ as contract
from finquarry.plans import QUERIES
from tests.compare import check_engine, compare

SF = "/root/testdata/sf0.001"
WITHOUT_SQL = {"dp_noisy_count", "encrypt_column", "sink_compression"}
SAMPLE = ["customer_360", "join_as_of", "join_skew_salt", "join_scd2_point_in_time", "win_rank", "win_moving_avg_5_centred", "rec_bom", "scd2", "cdc_apply", "dq_results", "fraud_score", "aml_str", "npa_trend", "call_report", "lineage_validate", "st_dedup", "st_session", "product_affinity", "percentile_analysis", "mdm_golden_record"]


def test_every_query_has_check_sql_unless_sql_cannot_express_it():
    assert {n for n, q in QUERIES.items() if not q.sql} == WITHOUT_SQL
    assert len(QUERIES) > 500 and set(QUERIES) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.fixture(scope="module")
def engine():
    return check_engine(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_against_check_engine(spark, engine, name):
    problem, _ = compare(spark, engine, name, SF)
    assert problem is None, problem
