import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinworks.sources import files
from skeinworks.sources.judge import StubJudge, votes
from skeinworks.streaming import shards

SCHEMA = T.StructType([T.StructField("problem", T.StringType()), T.StructField("n", T.LongType())])


def test_tables_by_extension(spark, tmp_path):
    df = spark.createDataFrame([("a,\"b\"", 1), (None, 2)], "s string, n long")
    for ext in ("parquet", "csv"):
        files.save_table(df, f"{tmp_path}/t.{ext}")
        assert {r.n for r in files.load_table(spark, f"{tmp_path}/t.{ext}", df.schema).collect()} == {1, 2}
    with pytest.raises(ValueError):
        files.load_table(spark, "t.txt")
    with pytest.raises(ValueError):
        files.save_table(df, "t.orc")


def test_jsonl(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"problem": "é", "n": 1}\n\n{"problem": "b"}\n', encoding="utf-8")
    assert sorted(tuple(r) for r in files.read_jsonl(spark, str(p), SCHEMA).collect()) == [("b", None), ("é", 1)]
    files.write_jsonl(files.read_jsonl(spark, str(p), SCHEMA), f"{tmp_path}/out")
    assert files.read_jsonl(spark, f"{tmp_path}/out", SCHEMA).count() == 2
    p.write_text('{"problem": \n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(p), SCHEMA).collect()


def test_provenance_and_seeds(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"problem": "a"}\nnot json\n')
    got = files.read_with_provenance(spark, str(tmp_path), SCHEMA).collect()
    assert [(r.problem, r.source_file) for r in got] == [("a", "x.jsonl")]
    (tmp_path / "s.jsonl").write_text('{"problem": "p", "type": "Algebra"}\n')
    assert tuple(files.read_seed_lines(spark, str(tmp_path / "s.jsonl")).first()) == ("p", "", "", "Algebra")


def test_trees_of_json(spark, tmp_path):
    for folder, name, text in (("b", "10.json", '{"problem": "b10"}'), ("a", "2.json", '{"problem": "a2", "level": "Level 1"}'), ("a", "10.json", '{"problem": "a10"}'), ("a", "x.json", '{"problem": " "}')):
        (tmp_path / "t" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "t" / folder / name).write_text(text)
    got = files.read_ordered_json(spark, f"{tmp_path}/t").orderBy("position").collect()
    assert [(r.position, r.problem) for r in got] == [(0, "a2"), (1, "a10"), (2, "b10")]
    (tmp_path / "t" / "a" / "bad.json").write_text("{")
    assert {(r.problem, r.subject) for r in files.read_json_tree(spark, f"{tmp_path}/t").collect()} >= {("a2", "a"), ("b10", "b")}


def test_catalogue_and_outline(spark, tmp_path):
    (tmp_path / "c.csv").write_text("code,l1,desc\n05A05,5,x\n05A05,5,y\n05-XX,5,z\n")
    assert [tuple(r) for r in files.read_catalogue(spark, str(tmp_path / "c.csv")).collect()] == [("05A05", "05", "x")]
    (tmp_path / "d.csv").write_text("code,desc\n05A05,x\n")
    with pytest.raises(ValueError):
        files.read_catalogue(spark, str(tmp_path / "d.csv"))
    lines = spark.createDataFrame([("11-XX Number theory",), ("11Axx Elementary",), (" 11A05 Divisors ",), ("",), ("text",)], "value string")
    assert [tuple(r) for r in files.parse_outline(lines).collect()] == [("l1", "11", "Number theory"), ("l2", "11Axx", "Elementary"), ("full", "11A05", "Divisors")]


def test_ids_and_shards(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("a\n\n b \na\n")
    assert {r.id for r in files.read_ids(spark, str(tmp_path / "ids.txt")).collect()} == {"a", "b"}
    df = spark.range(250).withColumn("x", F.col("id") * 2)
    with pytest.raises(ValueError):
        files.write_shards(df, ["id"], f"{tmp_path}/bad")
    files.write_shards(df, ["id"], f"{tmp_path}/s", exact=False)
    got = spark.read.json(f"{tmp_path}/s").groupBy("shard").agg(F.count("*").alias("n"), F.min("id").alias("lo")).collect()
    assert {(r.shard, r.n, r.lo) for r in got} == {("shard_00001", 100, 0), ("shard_00002", 100, 100), ("shard_00003", 50, 200)}


def test_judge_is_the_same_everywhere(spark):
    p = spark.createDataFrame([(i, f"prompt {i}") for i in range(40)], "id long, prompt string")
    one = {tuple(r) for r in votes(p.repartition(1), StubJudge).collect()}
    assert one == {tuple(r) for r in votes(p.repartition(7), StubJudge).collect()} and len(one) == 120

    class Broken:
        def answer(self, prompt, voice):
            if voice == 0:
                raise RuntimeError("no")
            return "nothing here"

    errors = {r.error for r in votes(p, Broken, voices=2, retries=0).collect()}
    assert errors == {"RuntimeError", "unreadable"}


def test_stream_stores_rows_once(spark, tmp_path):
    rows = [(1, "2026-01-01 00:00:00"), (2, "2026-01-01 00:01:00"), (1, "2026-01-01 00:02:00"), (3, "2026-01-01 00:03:00")]
    df = spark.createDataFrame(rows, "k long, t string").select("k", F.to_timestamp("t").alias("t"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = shards.stream_table(spark, f"{tmp_path}/in", df.schema)
    for _ in range(2):  # the second run finds nothing new
        shards.store_once(stream, ["k"], "t", "1 hour", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(60)
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3]


def test_window_counts_batch(spark):
    df = spark.createDataFrame([("a", "2026-01-01 00:00:30"), ("a", "2026-01-01 00:00:40"), ("b", "2026-01-01 00:01:10")], "k string, t string").select("k", F.to_timestamp("t").alias("t"))
    got = {(r.k, r.n) for r in shards.counts_by_window(df, "t", "1 minute", "1 minute", "k").collect()}
    assert got == {("a", 2), ("b", 1)}
