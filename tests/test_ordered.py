import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tuneframe.operators import packing as P
from tuneframe.plans import ordered as O


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of the rows, one null key, gaps in the values."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = 0 if i < 300 else (None if i < 320 else rng.randrange(1, 60))
        rows.append((key, rng.randrange(10**6) * 1000 + i, rng.randrange(100) if rng.random() > 0.1 else None))
    return spark.createDataFrame(rows, "k int, o long, v int").repartition(6).cache()


def brute(rows):
    groups, out = {}, {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        n, total, low = groups.get(k, (0, None, None))
        total = total if v is None else (total or 0) + v
        low = low if v is None else (v if low is None else min(low, v))
        groups[k] = (n + 1, total, low)
        out[(k, o)] = groups[k]
    return out


def test_running_by_key(skewed):
    totals = {"n": ("count", F.lit(1)), "s": ("sum", F.col("v")), "m": ("min", F.col("v"))}
    got = O.running(skewed, totals, ["o"], ["k"])
    want = brute([(r["k"], r["o"], r["v"]) for r in skewed.collect()])
    assert {(r["k"], r["o"]): (r["n"], r["s"], r["m"]) for r in got.collect()} == want


@pytest.mark.parametrize("slices", [None, 3, 200])
def test_tails(skewed, slices):
    got = O.running(skewed, {"n": ("count", F.lit(1))}, ["o"], ["k"], {"t": (3, F.col("v")), "u": (1, F.col("o"))}, slices)
    seen = {}
    for r in sorted(got.collect(), key=lambda r: r["o"]):
        before = seen.setdefault(r["k"], [])
        assert (r["n"], r["t"], r["u"]) == (len(before) + 1, [v for v, _ in before[-3:]], [o for _, o in before[-1:]])
        before.append((r["v"], r["o"]))
    assert sum(map(len, seen.values())) == 900


def test_running_over_the_table(skewed):
    got = O.running(skewed, {"s": ("sum", F.col("o")), "x": ("max", F.col("v"))}, ["o"])
    total, high = 0, None
    for r in sorted(got.collect(), key=lambda r: r["o"]):
        total += r["o"]
        high = r["v"] if high is None else (high if r["v"] is None else max(high, r["v"]))
        assert (r["s"], r["x"]) == (total, high)


def test_number_rows(skewed):
    numbered = O.number_rows(skewed, ["o"]).collect()
    assert [r["rn"] for r in sorted(numbered, key=lambda r: r["o"])] == list(range(1, 901))


@pytest.mark.parametrize("block", [4, 7, 1000])
def test_halo_frames(skewed, block):
    rows = O.number_rows(skewed, ["o"], ["k"])
    inner = Window.partitionBy("k", "block").orderBy("rn").rowsBetween(-4, -1)
    whole = Window.partitionBy("k").orderBy("rn").rowsBetween(-4, -1)
    cut = O.with_halo(rows, "rn", 4, block).withColumn("s", F.sum("v").over(inner)).filter("NOT is_halo")
    want = rows.withColumn("s", F.sum("v").over(whole)).select("k", "o", "s")
    got = cut.select("k", "o", "s")
    assert got.count() == 900 and got.exceptAll(want).isEmpty()


def test_halo_needs_room(skewed):
    with pytest.raises(ValueError):
        O.with_halo(skewed, "o", 5, 4)


def test_carries_stay_small(spark):
    """One carry per slice at most, however many keys there are."""
    df = spark.range(20000).select((F.col("id") % 5000).alias("k"), F.col("id").alias("o"))
    sliced = O.settle(df.repartitionByRange("k", "o").withColumn("__slice", F.spark_partition_id()))
    slices = sliced.select("__slice").distinct().count()
    assert O._carries(sliced, {"n": ("count", F.lit(1))}, ["k"]).count() < slices


def test_shuffle_is_a_permutation_fixed_by_the_seed(spark):
    ids = spark.range(500)
    first = {r["id"]: r["position"] for r in P.seeded_shuffle(ids, "id", 1).collect()}
    again = {r["id"]: r["position"] for r in P.seeded_shuffle(ids.repartition(3), "id", 1).collect()}
    other = {r["id"]: r["position"] for r in P.seeded_shuffle(ids, "id", 2).collect()}
    assert first == again != other and sorted(first.values()) == list(range(500))


def test_rows_without_a_key_keep_their_place(spark):
    rows = [(None, i) for i in range(40)] + [(i // 2, 100 + i) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, length int").repartition(4)
    shuffled = P.seeded_shuffle(df, "id", 5).collect()
    assert sorted(r["position"] for r in shuffled) == list(range(100))
    assert sorted((r["id"] is not None, r["length"]) for r in shuffled) == sorted((i is not None, n) for i, n in rows)
    assert {r["position"] for r in shuffled if r["id"] is None} == set(range(40))
    packed = P.pack_sequences(df, 64, "id").collect()
    assert len(packed) == 100 and packed[0].asDict().keys() == {"id", "length", "start", "first_block", "last_block"}
    ends = sorted((r["start"], r["start"] + r["length"]) for r in packed)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and ends[-1][1] == sum(n for _, n in rows)


def test_the_table_is_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(x):
        seen.add(1)
        return x

    df = spark.range(300).withColumn("length", counted("id"))
    P.pack_sequences(df, 16, "id").collect()
    assert seen.value == 300


def test_steps(spark):
    steps = P.assign_steps(spark.range(21).withColumnRenamed("id", "position"), 2, 4)
    rows = sorted((r["position"], r["step"], r["micro_batch"]) for r in steps.collect())
    assert rows[-1] == (20, 2, 2) and len({s for _, s, _ in rows}) == 3
    assert rows[7] == (7, 0, 3)


def test_packing(spark):
    lengths = [3, 5, 0, 2, 10, 1, 7, 4]
    df = spark.createDataFrame(list(enumerate(lengths)), "id int, length int")
    packed = P.pack_sequences(df, 4, "id")
    start = 0
    for r in sorted(packed.collect(), key=lambda r: r["id"]):
        assert r["start"] == start
        assert r["first_block"] == start // 4
        start += r["length"]
        if r["length"]:
            assert r["last_block"] == (start - 1) // 4
    blocks = sorted((r["block"], r["tokens"]) for r in P.pack_blocks(packed, 4).collect())
    assert blocks == [(b, 4) for b in range(8)]
