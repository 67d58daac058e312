"""Physical-plan properties: pruning, pushdown, shuffles, no global windows."""
import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()   # final (adaptive) plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pruning_and_pushdown(spark):
    p = plan_of(E.queries()["cust_features"](spark, SF))
    li = [ln for ln in p.split("\n") if "FileScan parquet" in ln and "l_orderkey" in ln][0]
    cols = re.search(r"FileScan parquet \[([^\]]*)\]", li).group(1).split(",")
    assert len(cols) == 4                      # of the table's 11 columns
    assert "PushedFilters: [IsNotNull(l_orderkey)" in li


def test_one_aggregation_exchange_for_features(spark):
    p = plan_of(E.queries()["cust_features"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(CustomerID", p)) == 1
    assert "SortMergeJoin" not in p            # dimension sides are small -> broadcast


def test_join_chain_needs_many_more_exchanges(spark):
    p = plan_of(E.queries()["features_by_joins"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(CustomerID", p)) >= 9


def test_label_split_is_one_pass(spark):
    p = plan_of(E.queries()["features_target_split"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(CustomerID", p)) == 1
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p


def test_no_single_partition_window_on_data(spark):
    """Positions come from range partitions + offsets: the only window runs
    over the per-partition counts (``_pid``), never over data rows."""
    for name in ("series_split", "rank_change"):
        p = plan_of(E.queries()[name](spark, SF))
        windows = [ln for ln in p.split("\n") if re.search(r"\bWindow \[", ln)]
        assert windows and all("_pid" in ln for ln in windows), windows
