"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from loadwitness.operators import compare as cmp
from loadwitness.operators import checks, results, status
from loadwitness.registry import QUERIES, Data

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "InPandas", "InArrow", "MapPartitions"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert [word for word in FORBIDDEN if word in plan] == []


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_keys_travel_alone(spark):
    """The first pass shuffles two keys and two counts, added up before the shuffle."""
    orders = Data(spark, FOLDER).orders
    fields = cmp.shared_columns(orders, orders)
    plan = plan_of(cmp.side_counts(cmp.with_keys(orders, fields), cmp.with_keys(orders, fields)))
    assert plan.count("Exchange") == 1
    before = plan[plan.index("Exchange") :]
    assert "partial_sum(s" in before and "SortAggregate" not in plan


def test_equal_rows_leave_before_anything_wide_is_shuffled(spark, no_broadcast):
    """No exchange of compared columns stands below the join with the table of bits, whatever the number of differences."""
    orders = Data(spark, FOLDER).orders
    for some in (orders.limit(10), orders.where("o_orderkey % 3 = 0")):
        plan = plan_of(cmp.compare(orders, some, sides=[cmp.SOURCE_ONLY]))
        bits = plan.index("BroadcastHashJoin")
        assert "_word" in plan[bits : plan.index("\n", bits)]
        below = [line for line in plan[bits:].split("\n") if "Exchange hash" in line]
        assert not any("_v0" in line or "o_orderkey" in line for line in below)
        assert plan[:bits].count("Exchange hash") <= 2  # what is let through once; its keys have their own


def test_columns_and_filters_reach_the_scan(spark):
    lines = Data(spark, FOLDER).lineitem
    plan = plan_of(checks.duplicate_groups(lines, ["l_orderkey"]))
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    plan = plan_of(status.with_codes(lines, "l_linenumber", [1, 2]).select("l_orderkey"))
    assert "PushedFilters: [In(l_linenumber, [1,2])]" in plan
    assert "ReadSchema: struct<>" in plan_of(cmp.row_count(lines, lines))


def test_long_lists_are_spread(spark):
    found = results.discrepancies(Data(spark, FOLDER).validation_result)
    plan = plan_of(results.preview(found))
    assert "_spread" in plan[plan.index("Window") : plan.index("Exchange")]


def test_facts_use_hashed_partial_aggregates(spark):
    d = Data(spark, FOLDER)
    plan = plan_of(results.step_facts(d.validation_result))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_latest_status_is_reduced_before_the_shuffle(spark):
    plan = plan_of(status.latest_status(Data(spark, FOLDER).flow_status))
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan[plan.index("Exchange") :]


def test_salting_spreads_a_hot_key(spark, no_broadcast):
    from loadwitness.operators.skew import SALTS, salted_join

    big = spark.range(20_000).selectExpr("0 AS k", "id AS v")
    small = spark.createDataFrame([(0, "x")], "k int, w string")
    joined = salted_join(big, small, ["k"], ["v"])
    plan = plan_of(joined)
    assert "_salt" in plan[plan.index("Exchange") :]
    salts = big.select(F.pmod(F.xxhash64("v"), F.lit(SALTS)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == SALTS and max(r["count"] for r in salts) < 20_000 / SALTS * 1.3


def test_only_counted_hot_keys_are_salted(spark, no_broadcast):
    from loadwitness.operators.skew import counted_join

    big = spark.range(4_000).selectExpr("if(id < 3000, 0, if(id % 9 = 0, null, id)) AS k", "id % 2000 AS v")
    small = spark.range(4_000).selectExpr("id AS k", "id % 3 AS w").union(spark.sql("SELECT 0L, 7L UNION ALL SELECT NULL, 1L"))
    wanted = sorted(map(repr, big.join(small, "k").select("k", "v", "w").collect()))
    cool = counted_join(big, small, ["k"], ["v"])
    assert "_salt" not in plan_of(cool) and "Generate" not in plan_of(cool)
    salted = counted_join(big, small, ["k"], ["v"], hot=500)
    assert "_salt" in plan_of(salted)
    for found in (cool, salted, counted_join(big, small, ["k"], ["v"], counted=big.select("k"), hot=1)):
        assert found.columns == ["k", "v", "w"]
        assert sorted(map(repr, found.collect())) == wanted
    assert counted_join(big.where("false"), small, ["k"], ["v"]).collect() == []


def test_node_lists_are_not_copied_without_a_hot_pipeline(spark):
    from loadwitness.registry.inputs import nodes

    assert "_salt" not in plan_of(nodes(Data(spark, FOLDER)))


def test_null_keys_are_spread(spark, no_broadcast):
    """Rows without a key match nothing; they do not meet in one task, and the result is that of a plain left join."""
    from loadwitness.operators.skew import join_nulls_apart

    left = spark.range(3000).selectExpr("if(id % 3 = 0, null, id % 7) AS k", "id AS v")
    right = spark.sql("SELECT * FROM VALUES (0, 'a'), (1, 'b'), (null, 'c') t(k, w)").selectExpr("cast(k AS bigint) AS k", "w")
    found = join_nulls_apart(left, right, ["k"], ["v"])
    plan = plan_of(found)
    exchange = plan[plan.index("Exchange hashpartitioning") :]
    assert "_apart" in exchange[: exchange.index("\n")]
    wanted = left.join(right, "k", "left").select("k", "v", "w")
    assert sorted(map(repr, found.select("k", "v", "w").collect())) == sorted(map(repr, wanted.collect()))


def test_node_lists_are_written_once(spark):
    """The plan of the runs that reports take starts from a written table, so each input is read a few times at most."""
    from loadwitness.plans.dataflow import report_runs
    from loadwitness.registry.inputs import run_nodes

    d = Data(spark, FOLDER)
    plan = report_runs(run_nodes(d), d.workflow, d.workflow_node)._jdf.queryExecution().optimizedPlan().toString()
    direct = d.workflow_node._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") <= direct.count("parquet") + 2 * max(1, d.workflow._jdf.queryExecution().optimizedPlan().toString().count("parquet"))


def test_unresolved_runs_stay(spark):
    from loadwitness.operators.workflow import resolve_run

    known = spark.createDataFrame([(1, 10, 100)], "node_batch_id long, workflow_orch_id long, batch_id long")
    wanted = spark.createDataFrame([(1,), (2,), (2,)], "node_batch_id long")
    rows = [tuple(r) for r in resolve_run(known, wanted).orderBy("node_batch_id").collect()]
    assert rows == [(1, 10, 100, True), (2, None, None, False)]


def test_checks_of_a_mapping_share_the_first_scan(spark):
    """Counts, nulls and probes come from the comparison's first scan: what they add to a plan reads no file."""
    d = Data(spark, FOLDER)
    equal = checks.check_sides(d.orders, d.orders, not_null=["o_orderkey", "o_orderpriority"])
    assert "FileScan" not in plan_of(equal) and "Scan parquet" not in plan_of(equal)
    assert {r.status for r in equal.collect()} == {"passed"}
    less = d.orders.where("o_orderkey % 3 = 0")
    apart, whole = cmp.compare(d.orders, less), checks.check_sides(d.orders, less, not_null=["o_orderkey"])
    assert plan_of(whole).count("FileScan") == plan_of(apart).count("FileScan") > 0


@pytest.mark.parametrize(
    "name",
    [
        "execution_meta", "workspace_lookup", "workspace_url", "report_header", "ingestion_failed", "node_status_left",
        "default_na", "child_workflow", "report_runs", "discrepancy_preview", "detailed_log",
    ],
)
def test_sides_that_grow_with_the_runs_are_neither_copied_nor_broadcast(spark, name):
    """A copy per salt was broadcast by an estimate that left out the copies: 14.4 million rows for 900,000 pipelines. What
    Spark may still broadcast is a semi-join's ids."""
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "_salt" not in plan
    joins = [line for line in plan.split("\n") if "BroadcastHashJoin" in line]
    assert [line for line in joins if "LeftSemi" not in line] == []


def test_exported_discrepancies_meet_their_pipelines_by_shuffle(spark):
    from loadwitness.registry.scans import _of_pipelines

    plan = plan_of(_of_pipelines(Data(spark, FOLDER)))
    assert "Broadcast" not in plan and "_salt" not in plan


def test_left_joins_salt_counted_hot_keys_and_spread_many_nulls(spark, no_broadcast):
    from loadwitness.operators.skew import counted_join

    big = spark.range(4_000).selectExpr("if(id < 3000, 0, if(id % 2 = 0, null, id)) AS k", "id AS v")
    small = spark.range(3_500).selectExpr("id AS k", "id % 3 AS w").union(spark.sql("SELECT 0L, 7L UNION ALL SELECT NULL, 1L"))
    wanted = sorted(map(repr, big.join(small, "k", "left").select("k", "v", "w").collect()))
    for hot in (1, 400, 10_000):
        found = counted_join(big, small, ["k"], ["v"], hot=hot, how="left")
        assert ("_salt" in plan_of(found)) == (hot < 10_000)
        assert found.columns == ["k", "v", "w"]
        assert sorted(map(repr, found.collect())) == wanted
    with pytest.raises(ValueError):
        counted_join(big, small, ["k"], ["v"], how="left_semi")


def test_saved_results_meet_their_last_saves_by_shuffle(spark, tmp_path):
    """There is a row per load among the last saves, and its broadcast table is memory of every task."""
    from loadwitness.sources.sinks import load_results, replace_results

    rows = spark.sql("SELECT id AS batch_id, 'data' AS validation_type, 'x' AS comment, id AS seq FROM range(20)")
    replace_results(rows, str(tmp_path))
    replace_results(rows.where("batch_id < 5").withColumn("comment", F.lit("y")), str(tmp_path))
    found = load_results(spark, str(tmp_path))
    assert "Broadcast" not in plan_of(found)
    assert sorted((r.batch_id, r.comment) for r in found.collect()) == [(i, "y" if i < 5 else "x") for i in range(20)]
