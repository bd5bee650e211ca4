"""The Hilbert curve and the shards cut from it, against a plain version on the driver."""

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tuneframe.llm import sharding
from tuneframe.llm.queries import QUERIES


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_and_steps_to_a_neighbour(spark, dims, bits):
    grid = [list(x) for x in itertools.product(range(1 << bits), repeat=dims)]
    df = spark.createDataFrame([(x,) for x in grid], "x array<long>").select("x", sharding.curve_index(F.col("x"), dims, bits).alias("at"))
    path = [x for _, x in sorted((r["at"], r["x"]) for r in df.collect())]
    assert sorted(path) == sorted(grid) and path[0] == [0] * dims
    assert {r["at"] for r in df.collect()} == set(range(len(grid)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def place_on_curve(cells, bits):
    """Skilling's transform, coordinate by coordinate."""
    x, n = list(cells), len(cells)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    digits = [(v ^ t) >> b & 1 for b in range(bits - 1, -1, -1) for v in x]
    return int("".join(map(str, digits)), 2)


def by_brute_force(rows, n_shards=16, law="rows"):
    """rows: (doc_id, text, lang, source)."""
    total = len(rows)

    def ranks(values):
        order = sorted(v.encode() for v in values)
        return lambda v: order.index(v.encode()) * 32 // total

    lang, source = ranks([r[2] or "" for r in rows]), ranks([r[3] or "" for r in rows])
    ids = [r[0] for r in rows if r[0] is not None]
    low, high = (min(ids), max(ids)) if ids else (0, 0)
    laid = []
    for i, t, a, b in rows:
        size = len((t or "").encode()) + 1
        digits = size.bit_length()
        octave = min(31, 2 * (digits - 1) + (size >> (digits - 2) & 1 if digits > 1 else 0))
        cells = [lang(a or ""), source(b or ""), octave, 0 if i is None else (i - low) * 32 // (high - low + 1)]
        laid.append((place_on_curve(cells, 5), i is not None, i or 0, zlib.crc32((t or "").encode()), size))
    laid.sort()
    n_bytes, at, seen, out = sum(x[-1] for x in laid), 0, {}, []
    for place, (curve, known, i, crc, size) in enumerate(laid):
        shard = place * n_shards // total if law == "rows" else at * n_shards // n_bytes
        at += size
        seen[shard] = seen.get(shard, -1) + 1
        out.append((i if known else None, size, crc, law, shard, seen[shard], None, curve))
    return sorted(out, key=repr)


def made_rows(n=700, seed=3):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(10_000) - 300, "x" * int(2 ** rnd.uniform(0, 14)), rnd.choice(["en", "en", "de", None, "é"]), f"s{min(9, rnd.randrange(20))}") for _ in range(n)]
    return rows + [(None, "a", "en", None), (None, None, None, None), (5, "", "", "s9"), (7, "é" * 20_000, "en", "s1")] + [(1, "copy", "en", "s9")] * 300 + [(2**62, "far", "fr", "s3")]


@pytest.mark.parametrize("law", sharding.LAWS)
@pytest.mark.parametrize("n_shards", [16, 7])
def test_shards(spark, law, n_shards):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = sharding.sharded(df, n_shards, law=law)
    assert sorted(map(tuple, got.collect()), key=repr) == by_brute_force(rows, n_shards, law)


def test_query_on_documents(spark, sf_dir):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_sharding"](spark, sf_dir).collect()), key=repr) == by_brute_force(rows)


def test_files_are_pruned_in_every_dimension(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(i, "x" * int(2 ** rnd.uniform(0, 12)), rnd.choice(["de", "en", "es", "fr"]), f"s{rnd.randrange(8)}", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard long")
    back = sharding.write_shards(df, str(tmp_path / "shards"), n_shards=64)
    assert sorted(back.columns) == sorted(df.columns) and back.drop("shard").exceptAll(df.drop("shard")).isEmpty() and back.count() == len(rows)
    size = F.length("text")
    ends = back.groupBy("shard").agg(*[f(c).alias(n + k) for k, c in (("l", F.col("lang")), ("s", F.col("source")), ("n", size), ("d", F.col("doc_id"))) for n, f in (("a", F.min), ("b", F.max))])
    for touched in ("al <= 'fr' AND bl >= 'fr'", "as <= 's2' AND bs >= 's2'", "bn >= 2000", "ad <= 100"):
        assert 0 < ends.filter(touched).count() <= 40, touched
    assert 0 < ends.filter("al <= 'fr' AND bl >= 'fr' AND as <= 's2' AND bs >= 's2'").count() <= 20


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    for law in sharding.LAWS:
        assert sharding.sharded(empty, law=law).count() == 0
    odd = spark.createDataFrame([("b", "x", 1, 2, 3), ("a", None, 4, 5, 6), (None, "y", 7, 8, 9)], "`my id` string, `my text` string, key int, curve int, row int")
    got = sharding.sharded(odd, 2, text="my text", key="my id")
    assert sorted((r["my id"] or "", r["size"], r["shard"], r["slot"]) for r in got.collect()) == [("", 2, 0, 1), ("a", 1, 0, 0), ("b", 2, 1, 0)]
    with pytest.raises(ValueError):
        sharding.sharded(odd, law="other")


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op13_sharding"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
