"""Registered queries against their SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from panelwise.plans import mapping_queries, panel_queries, reference_queries, registry  # noqa: F401

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4) + 0.0
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


CHECKED = """
a4_raw_scores a11_portfolio_returns a16_score_upsert a17_fundamentals_upsert a18_rate_upsert a19_membership_merge b10_consistent_improvers c5_asof_backward c15_common_names
d2_excess_by_period d14_beta_stability d16_expected_return_summary d17_pairwise_covariance d20_holding_summary d28_bootstrap d29_out_of_sample d31_hac_mean d33_last_date_distribution
e7_percentile_rank e16_rolling_stats e18_rolling_ewma e22_membership_intervals f3_five_factors f4_rolling_beta f6_two_factor f7_rolling_two_factor f9_rolling_factor f12_outcomes
f13_expected_returns f13_constant_expected_returns f14_expected_return_pipeline f15_contributions f19_horizon_spreads f21_portfolio_evaluation f22_constraints f23_frontier
f25_two_asset_grid f28_lag_sensitivity f31_sample_years g4_coverage g7_frequency_coverage g8_month_continuity g12_successors g18_outcomes g20_refetch_plan i15_observations
k1_stream_upsert k2_late_rows k5_window_counts k5_stream_windows k6_recorded_spells k4_monthly_bars a14_stored_factors a14_stored_expected_returns d12_describe d13_beta_statistics
d21_dispersion d34_performance e8_sector_neutral_legs e14_cumulative_drawdown e15_max_drawdown e20_year_to_date f12_rolling_change_beta f12_extremes f18_formation_methods
g24_membership_validation j1_quarter_means
""".split()


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, FOLDER)
    found = duck.execute(registry.SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    key = lambda row: [(v is None, str(v)) for v in row]
    want = sorted((tuple(norm(v) for _, v in sorted(zip(columns, row, strict=True))) for row in found.fetchall()), key=key)
    got = sorted((tuple(norm(row[c]) for c in sorted(columns)) for row in df.collect()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert all(x == pytest.approx(y, abs=2e-4) if isinstance(x, float) and isinstance(y, float) else x == y for x, y in zip(a, b, strict=True))
