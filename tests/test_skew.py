"""Hot keys: one code holding a third of all rows must not land in one task."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F


@contextmanager
def confs(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    try:
        for k, v in kv.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

from feedsync.operators import expand_seasons, salted_join
from feedsync.operators.skew import parts_of, rectangle


def skewed(spark, n=30000):
    # a third of the rows on one code, the rest spread over 2000 codes
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("P000001"))
        .otherwise(F.format_string("P%06d", (F.col("id") % 2000) + 2))
        .alias("prop_code"),
        (F.col("id") % 997).cast("int").alias("competitor_id"),
        (F.col("id") % 7 == 0).alias("is_host"),
    )


def seasons(spark):
    return spark.range(2002).select(
        F.format_string("P%06d", F.col("id")).alias("prop_code"),
        F.explode(F.array(F.lit(11), F.lit(12))).alias("season_id"),
    ).withColumn("we_ind", F.when(F.col("season_id") == 11, "N").otherwise("Y"))


def fanned(spark, big, small):
    """Both sides with their key's output rows, as the run's summary gives them."""
    n = big.groupBy("prop_code").count().join(small.groupBy("prop_code").count().withColumnRenamed("count", "m"), "prop_code")
    fan = n.select("prop_code", (F.col("count") * F.col("m")).alias("n_fan"), F.col("m").alias("n_season"))
    return big.join(fan, "prop_code"), small.join(fan, "prop_code"), fan


def test_salted_join_equals_plain_join(spark):
    big, small = skewed(spark), seasons(spark)
    plain = big.distinct().join(small.distinct(), "prop_code")
    b, s, _ = fanned(spark, big, small)
    for rows in (50, 2500, 10**9):
        salted = salted_join(b, s, ["prop_code"], "n_fan", "n_season", rows)
        assert salted.count() == plain.count()
        assert salted.exceptAll(plain.select(*salted.columns)).count() == 0


def test_hot_key_spread_over_tasks(spark):
    b, s, _ = fanned(spark, skewed(spark), seasons(spark))
    with confs(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        per_part = (
            salted_join(b, s, ["prop_code"], "n_fan", "n_season", 2500)
            .filter(F.col("prop_code") == "P000001")
            .withColumn("p", F.spark_partition_id())
            .groupBy("p")
            .count()
            .collect()
        )
    assert len(per_part) > 1
    assert max(r["count"] for r in per_part) < 20000


def test_code_large_on_both_sides_copies_little(spark):
    """3,000 listings by 2,000 seasons: the grid copies some 2 * sqrt(parts * L * S) rows,
    copying the season side alone would need S * parts."""
    listings, n_seasons, per_task = 3000, 2000, 10_000
    big = spark.range(listings).select(F.lit("P1").alias("prop_code"), F.col("id").cast("int").alias("competitor_id"))
    small = spark.range(n_seasons).select(F.lit("P1").alias("prop_code"), F.col("id").cast("int").alias("season_id"))
    sizes = {"n_fan": F.lit(listings * n_seasons), "n_season": F.lit(n_seasons)}
    a, b = spark.range(1).select(*rectangle(sizes["n_fan"], sizes["n_season"], per_task)).first()
    parts = -(-listings * n_seasons // per_task)
    assert parts <= a * b < 1.2 * parts + a
    copies = listings * b + n_seasons * a
    assert copies < 2.2 * (parts * listings * n_seasons) ** 0.5 < n_seasons * parts / 8
    out = salted_join(big.withColumns(sizes), small.withColumns(sizes), ["prop_code"], "n_fan", "n_season", per_task)
    with confs(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}):
        rows = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in rows) == listings * n_seasons
    assert len(rows) > 40 and max(r["count"] for r in rows) < listings * n_seasons / 15


@pytest.mark.parametrize("n_out, n_small", [(0, 0), (None, None), (1, 1), (10**12, 1), (10**12, 10**11), (7, 100)])
def test_grid_of_odd_sizes(spark, n_out, n_small):
    row = spark.createDataFrame([(n_out, n_small)], "o bigint, s bigint")
    a, b = row.select(*rectangle(F.col("o"), F.col("s"), 250_000)).first()
    assert a >= 1 and b >= 1
    assert a * b >= (n_out or 0) / 250_000


def test_every_one_of_many_hot_codes_is_split(spark):
    """No list of hot keys, so no limit on their number: 1,500 hot codes."""
    big = spark.range(1500 * 20).select(
        F.format_string("P%06d", F.col("id") % 1500).alias("prop_code"),
        (F.col("id") / 1500).cast("int").alias("competitor_id"),
        F.lit("N").alias("own_ind"),
    )
    small = spark.range(1500).select(
        F.format_string("P%06d", F.col("id")).alias("prop_code"),
        F.explode(F.array(F.lit(11), F.lit(12))).alias("season_id"),
        F.lit("N").alias("we_ind"),
    )
    b, s, fan = fanned(spark, big, small)
    counts = fan.select(parts_of(F.col("n_fan"), 10).alias("parts")).groupBy("parts").count().collect()
    assert [(r["parts"], r["count"]) for r in counts] == [(4, 1500)]
    lines = b.select("*", *(c.alias(n) for c, n in zip(rectangle(F.col("n_fan"), F.col("n_season"), 10), "ab", strict=True)))
    assert lines.filter("a <> 4 OR b <> 1").count() == 0  # few seasons: only the listings are cut
    spread = b.withColumn("part", F.pmod(F.xxhash64("prop_code", "competitor_id", "own_ind"), F.lit(4)))
    assert spread.groupBy("prop_code").agg(F.count_distinct("part").alias("n")).filter("n < 2").count() == 0
    out = expand_seasons(b, small, fan, 10)
    assert out.count() == 1500 * 20 * 2
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "TakeOrdered" not in plan and "Broadcast" not in plan


def test_adaptive_skew_join_splits_semi_join(spark):
    """With broadcast off, the tagging join of a hot code is split at run time."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        big = skewed(spark, 60000)
        # one row per code, read as a plain scan - the shape of the staged
        # per-code summary (skew splitting needs a shuffle on both sides)
        codes = spark.range(2002).select(F.format_string("P%06d", F.col("id")).alias("prop_code"), F.lit(1).alias("x"))
        j = big.join(codes, "prop_code", "left")
        assert len(j.collect()) == 60000
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan or "isSkew" in plan or "SkewJoin" in plan.replace(" ", "")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_adaptive_skew_split_before_distinct(spark):
    """Semi-join by code then distinct by (code, id) - the compset-diff shape.
    The split is forced although the distinct relied on the join's partitioning."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
        big = skewed(spark, 60000)
        codes = spark.range(2002).select(F.format_string("P%06d", F.col("id")).alias("prop_code"))
        j = big.join(codes, "prop_code", "left_semi").select("prop_code", "competitor_id").distinct()
        expect = big.select("prop_code", "competitor_id").distinct().count()
        assert len(j.collect()) == expect
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan or "isSkew" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_whole_run_with_a_third_of_the_feed_on_one_code(spark, fixtures_small):
    """Add listings for one matched code until it holds a third of the feed;
    the salted run must equal the plain run on every output."""
    from feedsync.plans.views import SkewConf, reconcile_views

    t = dict(fixtures_small)
    listing = t["listing"]
    n = listing.count()
    # P000001 is matched in the fixtures; give it competitor rows for many ids
    extra = spark.range(n // 2).select(
        F.lit("P000001").alias("raw_code"),
        F.lit("C").alias("role"),
        (F.col("id") + 5000).cast("string").alias("ext_id"),
        F.lit("X").alias("chain_name"),
        F.format_string("hotel %d", F.col("id")).alias("hotel_name"),
    )
    t["listing"] = listing.unionByName(extra)
    salted = reconcile_views(t, skew=SkewConf(rows_per_task=50))
    plain = reconcile_views(t)
    hot = salted["matched_rows"].groupBy("prop_code").count().orderBy(F.desc("count")).first()
    assert hot.prop_code == "P000001" and hot["count"] >= (n + n // 2) // 3
    for name in ("desired_config", "config_inserts", "config_deletes", "config_after", "compset_diff"):
        a, b = salted[name], plain[name]
        assert a.count() == b.count(), name
        assert a.exceptAll(b).count() == 0, name
