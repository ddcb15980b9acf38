"""Ordered groups of any size: even parts on hot keys and narrow values, results as over the whole group."""

import random

import pytest
from pyspark.sql import functions as F

from scoutlake.catalog import windows as queries
from scoutlake.catalog.views import stats
from scoutlake.operators import windows as win


def sizes(df):
    return [r["count"] for r in df.groupBy("_part").count().collect()]


def test_one_hot_key_is_many_parts(spark):
    df = spark.range(40_000).select(F.lit("m").alias("match"), F.col("id").alias("pos"), (F.col("id") % 7).alias("player"))
    assert sum(sizes(win.ordered_parts(df, ["match"], ["pos"]))) == 40_000
    with_conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = sizes(win.ordered_parts(df, ["match"], ["pos"]))
        assert len(parts) == 8 and max(parts) < 2 * 5_000
        got = win.next_actor(df, order=("pos",))
        assert got.filter("pos < 39999 AND next_player <> (pos + 1) % 7").count() == 0
        assert got.filter("next_player IS NULL").count() == 1
        assert win.running_index(df, ["match"], ["pos"]).filter("idx <> pos").count() == 0
        near = spark.range(30_000).select(F.lit("a").alias("part"), (1_000_000 + F.col("id") / 300).alias("value"))
        hist = sizes(win.ordered_parts(near, ["part"], ["value"]))
        assert len(hist) == 8 and max(hist) < 2 * 30_000 / 8
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_conf)


@pytest.mark.parametrize("share", [2000, 3, 1])
def test_percentiles_with_hot_values(spark, monkeypatch, share):
    monkeypatch.setattr(win, "HOT_VALUES", share)
    monkeypatch.setattr(win.join_counted, "__defaults__", (share,))
    rnd = random.Random(9)
    data = [(i, rnd.choice("ab"), rnd.choice([0.0, 0.0, None, -0.0, float(rnd.randrange(8)), 1e6 + rnd.random()])) for i in range(400)]
    df = spark.createDataFrame(data, "id int, part string, x double").repartition(4)
    got = {r["id"]: r["x"] for r in win.pct_rank(df, "part", "id", ["x"], decimals=6).collect()}
    for i, p, x in data:
        vals = [v for _, q, v in data if q == p and v is not None]
        if x is None:
            assert got[i] is None
        else:
            rank = sum(v < x for v in vals) + (sum(v == x for v in vals) + 1) / 2
            assert got[i] == pytest.approx(rank / len(vals) * 100, abs=1e-6)


def test_counted_join_spreads_hot_rows(spark):
    df = spark.range(9_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"))
    counted = df.groupBy("k").agg(F.count("*").alias("_n")).withColumn("v", F.col("k") * 2)
    out = win.join_counted(df, counted, ["k"], "v", share=50)
    assert out.count() == 9_000 and out.filter("v IS NULL OR v <> 2 * k").count() == 0
    missing = win.join_counted(df, counted.filter("k % 2 = 0"), ["k"], "v", share=50)
    assert missing.count() == 9_000 and missing.filter("v IS NULL").count() == df.filter("k % 2 <> 0").count()


def test_last_five_of_equal_keys_do_not_depend_on_the_order_of_rows(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    rows = stats(spark, sf).withColumns({"Match": F.lit(1).cast("long"), "ShirtNumber": F.lit(1)})  # every order column ties
    got = []
    for flip in (1, -1):
        data = sorted(rows.collect(), key=lambda r: (r["MinutesPlayed"] * flip, r["Passes"] * flip))
        frame = spark.createDataFrame(data, rows.schema).coalesce(1)
        monkeypatch.setattr(queries, "stats", lambda *_: frame)
        monkeypatch.setattr(queries, "matches", lambda *_: spark.sql("SELECT 1L AS ID, DATE '2024-01-01' AS Date"))
        got.append(sorted(map(str, queries.flagship(spark, sf).collect())))
    assert len(got[0]) > 100 and got[0] == got[1]
