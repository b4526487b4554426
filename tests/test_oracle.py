"""A selection of registered queries against their SQL on the smallest tables
(``check.py`` runs all of them)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck
from registry.oracle import ORACLE
from registry.queries import QUERIES

SELECTION = """
charge_classification amortized_cost_open_month service_name_resolution
cost_summary_lookback cost_fact_two_sources data_transfer tag_dim_two_sources
product_dim_delta account_dim_delta latest_tags_in_month usage_ec2 usage_alb
usage_one_account metric_json_scan upsert_transfer commitments_ri_coverage
star_load report_r01 report_r04 report_r05 report_r10 report_r13_payer_daily
report_r17 report_r21_never_equal reconcile_totals
""".split()


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


@pytest.mark.parametrize("name", SELECTION)
def test_query_matches_sql(spark, connection, sf, name):
    outcome = compare(spark, connection, name, sf)
    assert outcome.startswith("ok") and "types" not in outcome, outcome


def test_registry_is_consistent(spark):
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLE)
    assert entry(spark).columns == ["account_name", "amortized_cost"]
