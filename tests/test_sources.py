import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuneframe.functions.text import LengthLimits
from tuneframe.operators import rendering as R
from tuneframe.operators.lengths import add_lengths
from tuneframe.plans.prepare import prepare_samples
from tuneframe.session import shared_dir
from tuneframe.sources import prepared as P
from tuneframe.sources import splits as S
from tuneframe.streaming import rows as stream

LIMITS = LengthLimits(20)


def test_splits(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("train", "test")}
    spark.createDataFrame([("q", "a")], "question string, answer string").write.parquet(paths["train"])
    spark.createDataFrame([("q2",)], "question string").write.parquet(paths["test"])
    both = S.load_splits(spark, paths)
    assert sorted(map(str, both.collect())) == sorted(map(str, S.load_splits(spark, paths, None).collect()))
    assert {(r["split"], r["answer"]) for r in both.collect()} == {("train", "a"), ("test", None)}
    assert [r["question"] for r in S.load_splits(spark, paths, "test").collect()] == ["q2"]
    with pytest.raises(ValueError, match="train, test"):
        S.load_splits(spark, paths, "validation")


def test_jsonl(spark, tmp_path):
    (tmp_path / "train.jsonl").write_text('{"question": "q", "answer": "a"}\n{"question": "q2"}\n')
    rows = S.load_jsonl(spark, str(tmp_path / "train.jsonl"), "question string, answer string").collect()
    assert sorted(map(tuple, rows), key=str) == [("q", "a"), ("q2", None)]


def test_prepared_is_reused_unless_forced(spark, tmp_path):
    path, built = str(tmp_path / "prepared"), []

    def build(texts):
        built.append(1)
        return spark.createDataFrame([(t,) for t in texts], "text string")

    first = ["short", "", "word " * 200, "a b c"]
    run = lambda texts, **k: P.prepare_once(spark, path, lambda: build(texts), LIMITS, "d", "now", **k)
    assert not P.is_prepared(spark, path)
    assert {r["text"] for r in run(first).collect()} == {"short", "a b c"}
    assert {r["text"] for r in run(["other"]).collect()} == {"short", "a b c"} and len(built) == 1
    meta = P.read_metadata(spark, path).first().asDict()
    assert meta == {
        "original_samples": 4, "valid_samples": 2, "max_length": 250, "avg_length": (1 + 250 + 1) / 3,
        "median_length": 1, "filtered_count": 1, "max_seq_length": 20, "dataset_name": "d", "preprocessing_date": "now",
    }
    assert {r["text"] for r in run(["other"], force=True).collect()} == {"other"} and len(built) == 2


def test_stream_equals_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    df = spark.createDataFrame([(i, f"question {i}", "answer " * i) for i in range(30)], "id long, question string, answer string")
    df.repartition(3).write.parquet(path)
    limits = LengthLimits(60)
    out = stream.stream_samples(spark, path, df.schema, limits)
    query = out.writeStream.format("memory").queryName("streamed").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = sorted(map(str, spark.table("streamed").collect()))
    assert got == sorted(map(str, prepare_samples(df, limits).collect())) and 0 < len(got) < 30


def test_log_stream(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.log").write_text("ok\nUnable to detect language\nNo features in text here\nlast\n")
    query = (
        stream.stream_log_lines(spark, str(tmp_path / "logs")).writeStream.format("memory").queryName("lines").start()
    )
    query.processAllAvailable()
    query.stop()
    assert {r["line"] for r in spark.table("lines").collect()} == {"ok", "last"}


def test_shared_dir_is_the_named_one(spark):
    assert spark.conf.get("spark.checkpoint.dir") in shared_dir(spark)


def test_schema_of_prepared_metadata(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "text string")
    P.write_prepared(df, str(tmp_path / "p"), LIMITS, "d", "now")
    assert P.read_metadata(spark, str(tmp_path / "p")).schema == T.StructType(P.METADATA_SCHEMA.fields)
    assert P.read_prepared(spark, str(tmp_path / "p")).agg(F.count("*")).first()[0] == 1


def test_samples_are_rendered_once(spark, tmp_path):
    """Most samples are too long, so the median is one that is not kept."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def rendered(n):
        seen.add(1)
        return "x " * n

    samples = spark.range(1, 41).select(rendered("id").alias("text"), F.col("id").alias("key"))
    limits = LengthLimits(4)
    row = P.write_prepared(R.computed_once(samples, "text"), str(tmp_path / "p"), limits, "d", "now")
    assert seen.value == 40
    lengths = sorted(r["length"] for r in add_lengths(spark.range(1, 41).select(F.expr("repeat('x ', cast(id as int))").alias("text")), limits).collect())
    assert row["median_length"] == lengths[20] > 4 and row["valid_samples"] == sum(n <= 4 for n in lengths)
    kept = P.read_prepared(spark, str(tmp_path / "p"))
    assert kept.columns == ["text", "key"] and kept.count() == row["valid_samples"] and kept.filter("key IS NULL").isEmpty()


def test_files_are_written_by_many_tasks(spark, sf_dir):
    """A file for each supplier costs its time, so no single task may write them all."""
    from tuneframe.queries import evaluation, training

    tracker = spark.sparkContext.statusTracker()
    for name, write in (("results", evaluation.result_files), ("runs", training.read_run_files)):
        spark.sparkContext.setJobGroup(name, name)
        write(spark, sf_dir)
        spark.sparkContext.setJobGroup("", "")
        stages = [s for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds]
        assert max(tracker.getStageInfo(s).numTasks for s in stages[:4] if tracker.getStageInfo(s)) > 1


def test_files_as_spark_writes_them(spark, tmp_path):
    from tuneframe.queries.registry import write_files

    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), (None, 2, "é"), ("b", None, None)], "m string, n int, value string").coalesce(1)
    write_files(rows, str(tmp_path / "made"), "m", "n")
    rows.write.partitionBy("m", "n").text(str(tmp_path / "plain"))
    found = lambda d: {str(p.parent.relative_to(d)): sorted(p.read_bytes().split(b"\n")) for p in d.rglob("part-*")}
    assert found(tmp_path / "made") == found(tmp_path / "plain")
    write_files(rows.limit(0), str(tmp_path / "none"), "m", "n")
    assert list((tmp_path / "none").rglob("part-*")) == [] and (tmp_path / "none").is_dir()
