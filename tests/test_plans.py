"""The physical plans have the shape that holds at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from emisplit import bridge, staging
from emisplit.functions import grouping, salted, splittable, totals
from emisplit.session import tune

SF = "/root/testdata/sf0.001"


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["gas_split_factors", "pm_fractions", "gas_voc_to_tog", "gas_integrate_splits"])
def test_no_products_and_no_python(spark, name):
    plan = _plan(contract.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan


def test_scan_reads_what_it_needs(spark):
    plan = _plan(contract.queries()["csv_weights"](spark, SF))
    lineitem = [s for s in re.findall(r"ReadSchema: (\S+)", plan) if "l_" in s]
    assert lineitem and all("l_suppkey" not in s and "l_discount" not in s for s in lineitem)


@pytest.fixture
def static_plans(spark):
    """Plans as written: nothing reused or changed while they run."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.exchange.reuse": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.exchange.reuse")


CHAINS = ["gas_model_species", "gas_split_factors", "gas_vbs_splits", "pm_gap_filled_weights", "pm_fractions"]


def _shuffles(plan):
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


@pytest.mark.parametrize("name", [*CHAINS, "pm_vbs_fractions", "pm_camx_vbs_fractions", "gas_voc_to_tog_modes", "run_report", "gas_integrate_splits"])
def test_outputs_start_from_written_weights(spark, static_plans, name):
    """No output or report reads the source of the weights again."""
    plan = _plan(contract.queries()[name](spark, SF))
    assert not [s for s in re.findall(r"ReadSchema: (\S+)", plan) if "l_orderkey" in s]


@pytest.mark.parametrize("name", [*CHAINS, "gas_integrate_splits"])
def test_weights_are_not_shuffled_by_profile(spark, static_plans, name):
    """Totals per profile, and per profile and model species, work in the buckets the weights are written in."""
    plan = _plan(contract.queries()[name](spark, SF))
    shuffles = _shuffles(plan)
    # The factors of the volatility basis set are brought to the weights.
    assert shuffles.count("profile_id") <= (name == "gas_vbs_splits")
    # Rows that were shuffled by species go back once, and model species of a scenario once more.
    after = [k for k in shuffles if "profile_id" in k and k != "profile_id"]
    assert len(after) <= 2
    if name != "gas_integrate_splits":
        assert len(re.findall(r"\bExchange\b", plan)) <= 10


@pytest.mark.parametrize("name", ["gas_split_factors", "pm_fractions"])
def test_a_large_profile_is_cut_into_shares(spark, static_plans, name, monkeypatch):
    """With every profile large, no window takes one whole."""
    monkeypatch.setattr(grouping, "WHOLE", 0)
    plan = _plan(contract.queries()[name](spark, SF))
    groups = [
        re.sub(r"#\d+", "", keys)
        for keys in re.findall(r"Window \[.*?windowspecdefinition\((.*?#\d+(?:, \w+#\d+)*)[ ,]", plan)
        if "profile_id" in keys
    ]
    assert any("salt" in g for g in groups) and any("place" in g for g in groups)


def test_sizes_of_profiles_are_combined_before_the_shuffle(spark):
    rows = spark.range(0, 1000).selectExpr("cast(id % 3 as string) as profile_id", "id")
    sizes = rows.groupBy("profile_id").count()
    plan = _plan(sizes)
    assert plan.count("HashAggregate") == 2


@pytest.fixture
def small_partitions(spark):
    """Settings under which a few megabytes count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _skewed_rows(spark):
    return spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )


def test_hot_group_is_shared_out(spark, small_partitions):
    """No task gets a large part of a key that holds two thirds of the rows."""
    result = totals(salted(_skewed_rows(spark), "v"), ["k"], total=(F.sum, F.col("v")))
    tasks = result.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.when(F.col("k") == "hot", 1)).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = [r["n"] for r in tasks.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(held) == 133_334 and max(held) < 133_334 / 8 * 1.2
    rows = {r["k"]: r["total"] for r in result.groupBy("k").agg(F.max("total").alias("total")).collect()}
    assert rows["hot"] == sum(i for i in range(200_000) if i % 3 < 2) and len(rows) == 66_667


def test_skewed_join_with_an_aggregate_is_split(spark, small_partitions):
    """An aggregated side gets a shuffle of its own, so the join can be split."""
    rows = _skewed_rows(spark)
    listed = splittable(rows.select("k").distinct(), "k").withColumn("flag", F.lit(True))
    result = rows.join(listed, "k", "left").where("flag").groupBy("k").count()
    assert {r["k"]: r["count"] for r in result.collect()}["hot"] == 133_334
    assert "skew=true" in _plan(result)


@pytest.mark.parametrize("whole", [100, 4])
def test_weights_are_derived_once(spark, whole, monkeypatch):
    """Counting profiles, and writing large ones apart, start from what was written."""
    monkeypatch.setattr(grouping, "WHOLE", whole)
    derived = spark.sparkContext.accumulator(0)

    def counted(name):
        derived.add(1)
        return name

    name = F.udf(counted, "string")("specie_id")
    rows = [("a", str(i), i) for i in range(9)] + [(None, "x", 1), ("b", "y", 2)]
    weights = spark.createDataFrame(rows, "profile_id string, specie_id string, percent int").withColumn("specie_id", name)
    done = staging.staged(weights, lambda given: given.where("percent > 0"), lambda part: part, "w", {"ones": F.count_if(F.col("percent") == 1)})
    assert derived.value == len(rows) and done.counts == {"ones": 2}
    assert sorted(map(str, done.rows().collect())) == sorted(map(str, weights.where("percent > 0").collect()))
    assert (done.shares is not None) == (whole == 4)
    if done.shares is not None:
        assert {r["profile_id"] for r in done.shares.collect()} == {"a"}


def test_profiles_of_a_full_bin_are_counted_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(grouping, "WHOLE", 5)
    rows = spark.range(60).select(F.when(F.col("id") < 4, F.lit("p")).otherwise((F.col("id") % 14).cast("string")).alias("profile_id"))
    # One bin, as if there were no more rows than it takes: none of its profiles is large.
    assert staging._large(rows, 6) is None
    more = rows.union(spark.range(6).select(F.lit("p")))
    assert [r[0] for r in staging._large(more, 6).collect()] == ["p"]


@pytest.mark.parametrize("given, used", [("64MB", 16 << 20), ("8m", 8 << 20), ("16m", 16 << 20)])
def test_a_task_takes_a_bounded_partition(spark, given, used):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, given)
    tune(spark)
    size = spark.conf.get(name)
    spark.conf.unset(name)
    tune(spark)
    assert size in (f"{used}b", f"{used >> 20}m")


def test_lines_are_dealt_out_before_user_weights_are_added_up(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(contract, "_run", lambda spark, scenario, tables: taken.append(tables.user_profile_wts) or contract.GasPlan)
    with pytest.raises(AttributeError):
        contract.gas_user_weights_splits(spark, SF)
    above, below = taken[0]._jdf.queryExecution().sparkPlan().toString().split("Exchange hashpartitioning(l_suppkey", 1)
    assert "Aggregate" in above and "Aggregate" not in below and "Exchange" not in below


def test_shares_of_orders_read_lines_once(spark):
    """Lines without an order give no weight; those without a part or quantity count as before."""
    for weights in (bridge.gas_weights(spark, SF), bridge.pm_weights(spark, SF)):
        plan = weights._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Relation \[l_", plan)) == 1
