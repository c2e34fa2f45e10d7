"""Every registered query: same values as its SQL, or at least a result."""

import pytest

from tests.compare import compare
from tidemark.queries import ORACLES, QUERIES

SLOW = {"betweenness", "logistic_scores", "boosted_importances", "forest_scores"}

# Operators with a separate plan for keys that hold many rows.
SPLIT = (
    "hours_since_last acceleration days_since_last velocity zscore running_high_low price_change "
    "sessions_gap every_nth_event rapid_fire sustained_alert asof_features online_lookup "
    "risk_profile_p95 high_amount_flag quality_metrics data_profile ks_drift response_times "
    "feature_merge counter_increase users_joined model_features communities"
).split()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, folder, name):
    count, _, problem = compare(spark, duck, folder, name, QUERIES[name], ORACLES.get(name))
    assert problem is None
    if name not in ORACLES:
        assert count > 0


@pytest.mark.parametrize("name", SPLIT)
def test_query_with_hot_keys(spark, duck, folder, hot, name):
    assert compare(spark, duck, folder, name, QUERIES[name], ORACLES[name])[2] is None


def test_entry_points(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["event_date", "event_type", "event_count"]
    assert set(driver.oracle_sql()) <= set(driver.queries())
