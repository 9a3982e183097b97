"""Plan properties that matter at scale (checked on the executed plans)."""

from featflow.operators.windows import pickup_features_fn
from featflow.plans import monitoring, taxi, tracking
from featflow.plans.fixtures import trips

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    """The final (post-AQE) physical plan: run the frame's own query execution."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan().toString()
    assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan
    return plan.split("== Initial Plan ==")[0]


def test_feature_scan_is_pruned_and_filtered(spark):
    plan = _plan(pickup_features_fn(trips(spark, SF), "tpep_pickup_datetime",
                                    "2024-01-02", "2024-01-20"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    # Only the columns the features need are read from events.
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_training_set_broadcasts_features_and_never_shuffles_trips(spark):
    plan = _plan(taxi.training_frame(spark, SF))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan
    assert "hashpartitioning(pickup_zip" not in plan and "hashpartitioning(dropoff_zip" not in plan


def test_aggregations_combine_map_side(spark):
    for df in (pickup_features_fn(trips(spark, SF)), monitoring.q_hist_by_year(spark, SF),
               tracking.q_runs_latest(spark, SF)):
        plan = _plan(df)
        assert "partial_" in plan  # partial aggregate before the shuffle
        assert "Python" not in plan
