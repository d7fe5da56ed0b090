"""Registered queries against their SQL. TIDEWELL_ALL_QUERIES=1 runs every one of them."""

import os

import pytest
from conftest import SF
from oracle_check import compare

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
SHORT = """agg_02_revenue_by_category agg_05_user_behavior agg_09_customer_summary agg_12_cube_revenue agg_14_exact_quantiles
cdc_01_latest_image cdc_02_order_details cdc_07_merge_upsert cdc_10_scd2 dq_01_null_profile dq_04_quality_score dq_07_user_alerts
fea_01_historical_features fea_03_rolling_features fn_date_times fn_json_values gra_03_pagerank gra_08_components join_08_asof_join
join_12_interval_join lak_02_z_value ord_03_top_k_per prj_02_sales_fact sea_01_cosine_topk set_03_snapshot_diff sta_03_product_popularity
sta_06_fraud_state str_01_tumbling_counts_stream str_10_session_windows str_17_behavior_patterns ts_01_indicators win_01_purchase_sequence
win_08_terciles win_12_daily_growth join_08_asof_join_stream join_12_interval_join_stream sta_01_user_profile_stream str_12_hourly_rollup_stream
str_23_split_late udf_04_user_aggregate src_12_incremental_at_ties ml_01_train_tabular ts_03_gap_fill""".split()
NAMES = sorted(ORACLES) if os.environ.get("TIDEWELL_ALL_QUERIES") else SHORT


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    problem, count = compare(spark, duck, SF, name, QUERIES[name], ORACLES[name])
    assert problem is None
    assert count >= 0


HOT = """agg_14_exact_quantiles cdc_10_scd2 fea_03_rolling_features join_08_asof_join sta_06_fraud_state str_11_session_steps ts_04_rule_checks
win_01_purchase_sequence win_02_ranked_orders win_08_terciles win_11_position_stats""".split()


@pytest.mark.parametrize("name", HOT)
def test_query_with_every_group_split(spark, duck, name):
    spark.conf.set("spark.tidewell.hotGroupRows", "0")
    try:
        problem, _ = compare(spark, duck, SF, name, QUERIES[name], ORACLES[name])
    finally:
        spark.conf.unset("spark.tidewell.hotGroupRows")
    assert problem is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
