import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ackline.plans.joins import lookup_join
from ackline.plans.scan import Running, prefix_scan

KINDS = ["sum", "max", "last"]


def _rows(seed, groups, n, span):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        # Group 0 holds most rows.
        size = n if g == 0 else n // 10
        for key in rng.sample(range(-span, span), size):
            rows.append((g, key, rng.choice([None, rng.randint(-50, 50)])))
    return rows


@pytest.mark.parametrize("block_bits", [(3,), (3, 3), (40,), ()])
@pytest.mark.parametrize("reverse", [False, True])
def test_blocked_scan_equals_plain_window(spark, block_bits, reverse):
    df = spark.createDataFrame(_rows(7, 3, 300, 2000), "g int, k bigint, v bigint")
    runs = [Running(kind, F.col("v"), f"{kind}_{x}", x) for kind in KINDS for x in (False, True)]
    got = prefix_scan(df, "k", runs, group=["g"], block_bits=block_bits, reverse=reverse)

    order = F.desc("k") if reverse else F.asc("k")
    base = Window.partitionBy("g").orderBy(order)
    expected = df
    for run in runs:
        frame = base.rowsBetween(Window.unboundedPreceding, -1 if run.exclusive else 0)
        value = {
            "sum": F.coalesce(F.sum("v").over(frame), F.lit(0)),
            "max": F.max("v").over(frame),
            "last": F.last("v", ignorenulls=True).over(frame),
        }[run.kind]
        expected = expected.withColumn(run.name, value)
    assert sorted(map(str, got.select(expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_scan_without_group_and_with_ties(spark):
    df = spark.createDataFrame([(5, 1, 10), (5, 0, 1), (2**40, 0, 100), (-3, 0, 7)], "k bigint, t int, v bigint")
    got = prefix_scan(df, "k", [Running("sum", F.col("v"), "s")], ties=["t"], block_bits=(2, 20))
    assert {(r.k, r.t): r.s for r in got.collect()} == {(-3, 0): 7, (5, 0): 8, (5, 1): 18, (2**40, 0): 118}


def test_scan_keeps_block_for_colocated_join(spark):
    df = spark.createDataFrame([(0, k) for k in range(20)], "g int, k bigint")
    got = prefix_scan(df, "k", [Running("max", F.col("k"), "m")], group=["g"], block_bits=(2,), keep_block="b")
    assert {r.b for r in got.collect()} == {0, 1, 2, 3, 4}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_lookup_join_equals_plain_join(spark, how, broadcast):
    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(200)], "k int, i int")
    lookup = spark.createDataFrame([(k, k * 10) for k in range(0, 100, 2)], "k int, v int")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold if broadcast else "-1")
    try:
        got = lookup_join(rows, lookup, ["k"], how, spread=["i"]).collect()
        expected = rows.join(lookup, "k", how).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_lookup_join_refuses_right_preserving(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        lookup_join(df, df, ["id"], "full", spread=["id"])
