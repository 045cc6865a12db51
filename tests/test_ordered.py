"""Ranks and running totals over a global order against plain Python."""

import random

from pyspark.sql import functions as F

from faultline.operators.ordered import global_rank, running_totals


def _rows(n=3000):
    rnd = random.Random(4)
    return [(i, rnd.choice([None, *range(40)]), rnd.choice([None, *range(-5, 20)])) for i in range(n)]


def test_global_rank_equals_sorted_order(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, k int, v long").repartition(13)
    got = {r.id: r["rank"] for r in global_rank(df, [F.col("k").desc_nulls_last(), "id"]).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == {r[0]: i for i, r in enumerate(want, 1)}
    assert global_rank(df.limit(0), ["id"]).count() == 0


def test_running_totals_equal_a_plain_loop(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, k int, v long").repartition(13)
    got = {r.id: (r.before_v, r.all_v) for r in running_totals(df, ["k", "id"], ["v"]).collect()}
    total, want = 0, {}
    everything = sum(r[2] or 0 for r in rows)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0])):
        want[r[0]] = (total, everything)
        total += r[2] or 0
    assert got == want
    assert running_totals(df.limit(0), ["id"], ["v"]).columns == ["id", "k", "v", "before_v", "all_v"]
    assert running_totals(df.limit(0), ["id"], ["v"]).count() == 0


def test_one_value_in_most_rows_is_spread_by_a_tie_break(spark):
    df = spark.range(40_000).select(F.lit(7).alias("k"), "id", F.lit(1).cast("long").alias("v"))
    got = running_totals(df.repartition(6), ["k", "id"], ["v"])
    assert got.where("before_v <> id").count() == 0
