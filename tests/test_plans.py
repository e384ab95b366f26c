"""Plan shapes that must hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import attribution, identity, market
from tidemark.operators.key_filter import may_be_in
from tidemark.plans import carriers
from tidemark.plans.registry import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_broadcast(spark):
    return spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture(autouse=True)
def usual_conf(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_nested_loops_or_single_task_windows(spark, small_dir, name):
    without_broadcast(spark)
    plan = plan_of(QUERIES[name](spark, small_dir))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    # A window without partition keys would bring its rows into one partition.
    assert not ("SinglePartition" in plan and "Window" in plan)


def test_page_keeps_only_top_rows(spark, small_dir):
    plan = plan_of(market.market_page(carriers.assets(spark, small_dir), page=2))
    assert "TakeOrderedAndProject(limit=40" in plan.replace(" ", "")


def test_kpis_are_one_partial_aggregate(spark, small_dir):
    parts = carriers.table(spark, small_dir, "part").select(
        F.col("p_retailprice").alias("market_cap"),
        F.col("p_retailprice").alias("total_volume"),
        F.col("p_retailprice").alias(market.CHANGE),
    )
    plan = plan_of(market.kpis(parts))
    assert plan.count("FileScan") == 1 and "partial_sum" in plan and "partial_count" in plan
    assert "ReadSchema: struct<p_retailprice:double>" in plan


def test_duplicate_check_shuffles_wide_rows_once(spark, small_dir):
    """One scan of the members; the judged rows with their violations are shuffled once."""
    without_broadcast(spark)
    plan = QUERIES["signup_violations"](spark, small_dir)._jdf.queryExecution()
    told = spark._jvm.PythonSQLUtils.explainString(plan, "formatted")
    initial = told.split("== Initial Plan ==")[-1]
    shuffles = [part for part in initial.split("\n\n") if re.match(r"\s*\(\d+\) Exchange", part)]
    wide = [part for part in shuffles if "violations" in part.split("Arguments")[0]]
    assert len(shuffles) > 3 and len(wide) == 1
    # Members are every fourth customer; the sign-ups read the same table without that filter.
    assert told.count("PushedFilters: [") >= 0
    assert initial.count("% 4) = 0") == 1


def test_sections_need_no_join_or_shuffle(spark, small_dir):
    sections = carriers.sections_as_intervals(spark).collect()
    found = attribution.with_section(carriers.scroll(spark, small_dir), sections)
    plan = plan_of(found.select("event_id", "section_id"))
    assert "Join" not in plan and "Exchange" not in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_latest_snapshot_filter_reaches_the_scan(spark, small_dir):
    events = carriers.table(spark, small_dir, "events")
    plan = plan_of(market.latest_snapshot(events, "ts").select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), EqualTo(ts,ScalarSubquery" in plan


def test_point_lookup_is_pushed_down(spark, small_dir):
    parts = carriers.table(spark, small_dir, "part").withColumnRenamed("p_name", "id")
    assert "EqualTo(p_name,bolt)" in plan_of(market.find_asset(parts, "bolt"))


def test_hot_keys_are_split(spark):
    """A third of the candidates share one email and one secret, or one email only."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
    }
    before = {name: spark.conf.get(name) for name in confs}
    for name, value in confs.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 4000, 1, 8)
        key = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END"
        people = rows.selectExpr("id AS candidate_id", f"{key} AS email", f"{key} AS secret_digest")
        members = people.toDF("member_id", "email", "password_digest")
        alike = people.withColumn("secret_digest", F.sha2(F.col("candidate_id").cast("string"), 256))
        admins = members.drop("member_id")
        runs = [
            (identity.with_match_counts(people, members), 1),
            (identity.with_match_counts(alike, members), 1),
            (identity.admit_new(people, members.filter("member_id % 3 = 1"), "any"), 2),
            (identity.login_outcome(people, members, admins, secret="secret_digest"), 1),
        ]
        for df, joins in runs:
            df.collect()
            plan = plan_of(df).split("Initial Plan")[0]
            assert plan.count("SortMergeJoin(skew=true)") == joins, plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_candidate_keys_of_a_small_file_are_not_broadcast(spark, tmp_path):
    """A file of few bytes holds many rows, and three keys come of each: they meet the counts sorted."""
    rows = spark.range(3000).selectExpr(
        "id AS candidate_id", "concat('m', id % 2000) AS email", "concat('s', id % 3) AS secret_digest"
    )
    rows.write.parquet(str(tmp_path / "rows"))
    candidates = spark.read.parquet(str(tmp_path / "rows"))
    members = candidates.where("candidate_id % 2 = 0").toDF("member_id", "email", "password_digest")
    counted = identity.with_match_counts(candidates, members)
    assert counted.count() == 3000
    assert "BuildLeft" not in plan_of(counted)
    counted.collect()
    plan = plan_of(counted).split("Initial Plan")[0]
    assert "BuildLeft" not in plan and "SortMergeJoin" in plan


def test_key_filter_is_a_constant(spark):
    """The words of the filter are not made anew for each row."""
    keys = spark.range(20).selectExpr("concat('k', id) AS key")
    rows = spark.range(1000).selectExpr("concat('k', id) AS key").where(may_be_in(keys, "key", "key"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "getbit" in plan
    assert "split(" not in plan and "lambda" not in plan
