"""Physical-plan shape checks: pruning, partial aggregation, no single-task windows over raw rows."""
import re

from pyspark.sql import functions as F

from keepwise.operators.metrics import ranking_metrics
from keepwise.plans.base import featured_base
from keepwise.plans.catalog import QUERIES, load_all

load_all()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_per_feature_profile_prunes_columns_and_aggregates_partially(spark, sf_dir):
    plan = _plan(QUERIES["churn_rate_by_category"](spark, sf_dir))
    assert "partial_count" in plan and "partial_avg" in plan
    for schema in _read_schemas(plan):
        assert "customerID" not in schema and "TotalCharges" not in schema


def test_base_scan_pushes_filters_and_prunes(spark, sf_dir):
    f = featured_base(spark, sf_dir).where(F.col("Contract") == "Two year").select("customerID", "tenure")
    plan = _plan(f)
    assert "PushedFilters: [IsNotNull(Contract), EqualTo(Contract,Two year)]" in plan
    schemas = _read_schemas(plan)
    assert schemas and all("MonthlyCharges" not in s for s in schemas)


def test_ranking_metrics_never_window_over_a_single_partition_of_scores(spark, sf_dir):
    plan = _plan(ranking_metrics(featured_base(spark, sf_dir)))
    # the only windows are partitioned by bucket (running sums) or run over the per-bucket totals
    for line in plan.splitlines():
        if "Window [" in line and "windowspecdefinition(_bk" not in line:
            assert "sum(_t_n_" in line, line     # the unpartitioned window only sums per-bucket totals


def test_value_at_risk_rank_has_no_unpartitioned_row_window(spark, sf_dir):
    plan = _plan(QUERIES["value_at_risk_ranked"](spark, sf_dir))
    assert "row_number" not in plan              # ranks come from partition offsets, not a global window
    assert "BroadcastHashJoin" in plan           # offsets (one row per partition) are broadcast
