"""Answer forms, codes, batches, rotations and the rolling writer on small cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from skeinworks.functions import answers as A
from skeinworks.functions import codes as C
from skeinworks.functions import validate as V
from skeinworks.operators import relational as R
from skeinworks.operators import similarity as S
from skeinworks.operators.sampling import feedback_picks, rotated
from skeinworks.plans.batches import checked_batches
from skeinworks.plans.codes import auxiliary, final_codes, gated
from skeinworks.plans.search import coverage_starts, neighbourhood
from skeinworks.sources import files


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "usage,want",
    [
        ({"completion_tokens_details": {"text_tokens": 7, "output_tokens": 9}, "completion_tokens": 3}, 7),
        ({"completion_tokens_details": {"text_tokens": 0, "output_tokens": " 9 "}}, 9),
        ({"completion_tokens_details": {"text_tokens": "x"}, "output_tokens": 0, "completion_tokens": 4}, 0),
        ({"completion_tokens": 4.0}, 4),
        ({}, 0),
        (None, 0),
    ],
)
def test_completion_tokens(spark, usage, want):
    assert one(spark, A.completion_tokens, None if usage is None else json.dumps(usage)) == want


def test_normal_answer(spark):
    rows = [
        (1, "ok", "i", [f"Step {k}: s{k}" for k in range(10)], " 4 "),
        (2, "", "i", ["a"], "wrong problem"),
        (3, "odd", "i", None, "4"),
        (4, "wrong_problem", "i", [None, " "], ""),
        (5, None, None, ["a"] * 5, "4"),
        (6, "ok", "i", ["a"] * 4, "4"),
        (7, "ok", "i", ["a"], None),
    ]
    df = spark.createDataFrame(rows, "id int, v string, k string, s array<string>, f string")
    got = {r.id: r.x for r in df.select("id", A.normal_answer(F.col("v"), F.col("k"), F.col("s"), F.col("f")).alias("x")).collect()}
    assert got[1].verdict == "ok" and got[1].steps == [f"s{k}" for k in range(8)] and got[1].final == "4" and got[1].error is None
    assert (got[2].verdict, got[2].steps, got[2].idea) == ("wrong_problem", ["a"], "")
    assert got[4].steps == [A.NO_REASON] and got[4].final == "wrong problem"
    assert [got[k].error for k in (3, 5, 6, 7)] == ["empty_solution_steps", "empty_key_idea", "too_few_solution_steps", "empty_final_answer"]


def test_too_short_and_message_text(spark):
    df = spark.createDataFrame([("ok", 1300, 0, 100), ("ok", 1100, 0, 100), ("fail", 5, 0, 100), ("ok", 1300, 99, 100), ("ok", 1300, 0, 400)], "v string, n int, t int, least int")
    got = [r.s for r in df.select(A.too_short(F.col("v"), F.col("n"), F.col("t"), F.col("least")).alias("s")).collect()]
    assert got == [False, True, False, True, True]
    texts = ["plain", '[{"text": "a"}, {"type": "x"}, {"text": "b"}]', '{"text": "c"}', "{}", None]
    assert [one(spark, A.message_text, t) for t in texts] == ["plain", "a\nb", "c", "", ""]


def test_code_lists_and_defaults(spark):
    df = spark.createDataFrame([("see 11a05, 05C15 and 11A05", "11a05"), ("['26A09']", "05C15"), (None, "bad"), ("", None)], "v string, f string")
    assert [r.c for r in df.select(C.code_list(F.col("v"), F.col("f")).alias("c")).collect()] == [["11A05", "05C15"], ["05C15", "26A09"], [], []]
    assert one(spark, C.default_domain, "5") == "combinatorics" and one(spark, C.default_domain, None) == "algebra" and one(spark, C.default_code, "5") == "05A05"


CAND = "qid string, subject string, code string, score long, own string, allowed boolean"


def test_codes_are_repaired_gated_and_accompanied(spark):
    cand = spark.createDataFrame(
        [("q1", "s", "11A01", 5, "26", False), ("q1", "s", "26B01", 4, "26", True), ("q1", "s", "26B02", 3, "26", True), ("q1", "s", "26C03", 1, "26", True), ("q2", "s", "11A01", 2, "26", False), ("q2", "s", "26A01", 1, "26", False), ("q3", "s", "51A01", 1, "26", False)], CAND
    )
    final = final_codes(cand)
    assert {r.qid: (r.initial, r.final) for r in final.collect()} == {"q1": ("11A01", "26B01"), "q2": ("11A01", "26A01"), "q3": ("51A01", "51A01")}
    assert [(r.qid, r.code, r["rank"]) for r in auxiliary(cand, final).collect()] == [("q1", "26B02", 1)]
    assert auxiliary(cand, final, policy="none").count() == 0 and auxiliary(cand, final, policy="free", k=9).filter("qid = 'q1'").count() == 2
    rows = spark.createDataFrame([("q1", "s", "11A01", "no sign"), ("q2", "s", "11A01", "two integers"), ("q3", "s", "51A01", "x")], "qid string, subject string, final string, text string")
    got = {r.qid: (r.new_code, r.reason) for r in gated(rows, cand).collect()}
    assert got == {"q1": ("26B01", "needs_evidence_0"), "q2": ("11A01", ""), "q3": ("51A01", "")}


def test_batches_break_rules_in_order(spark):
    body = "A farmer keeps %d goats and sells %d of them at the market each week. Find the rest."
    plain = [(f"Some other text number {w} with 7 words of its own, and 12 more. Find it.") for w in ("alpha", "beta", "gamma", "delta")]
    row = lambda b, i, p, **k: (b, i, k.get("level", "easy"), p, k.get("seeds", [f"s{i}"]), k.get("nodes", ["n"]))
    rows = [row("ok", i, p) for i, p in enumerate(plain[:2])] + [row("few", 0, "x")] + [row("slot", 0, p) for p in plain[:2]] + [row("level", i, p, level="odd") for i, p in enumerate(plain[:2])]
    rows += [row("skel", i, body % (i + 3, i + 4)) for i in range(2)] + [row("seed", 0, plain[0], seeds=[]), row("seed", 1, plain[1])] + [row("node", 0, plain[0], nodes=[]), row("node", 1, plain[1])]
    rows += [row("copy", 0, plain[2], seeds=["s9"]), row("copy", 1, plain[3])] + [row("cover", 0, None, seeds=["s0"]), row("cover", 1, "", seeds=["s0"])]
    df = spark.createDataFrame(rows, "batch string, id long, level string, problem string, seeds array<string>, nodes array<string>")
    seeds = spark.createDataFrame([("s9", plain[2]), ("s0", None)], "qid string, problem string")
    got = {r.batch: r.error for r in checked_batches(df, seeds, size=2).collect()}
    assert got == {"ok": None, "few": "item_count", "slot": "slots", "level": "difficulty", "skel": "skeletons", "seed": "missing_seeds", "node": "missing_nodes", "copy": "too_close_to_seed", "cover": "seed_coverage"}


def test_lines_families_and_reports(spark):
    df = spark.createDataFrame([(None, None), (" ", ["", None]), ("Use a  Specific Rule", ["a", "b"]), ("certain points lie on it", ["a", "some condition"]), ("multiple teams", ["x", "y"])], "l string, s array<string>")
    got = [tuple(r) for r in df.select(V.line_error(F.col("l")), V.line_error(F.col("l"), True), V.list_error(F.col("s"), 2)).collect()]
    assert got == [("missing", "missing", "invalid"), ("missing", "missing", "too_short"), ("underspecified", "underspecified", None), ("underspecified", "underspecified", "underspecified"), (None, "underspecified", None)]
    texts = ["A random triangle", "Three points", "Choose a subset", "x mod 7", "A matrix", None]
    assert [one(spark, V.problem_family, t) for t in texts] == ["probability", "geometry", "counting", "equation_system", "algebraic_object", "algebraic_object"]
    reports = [(True, True, False, "ok", True), (None, True, False, "ok", True), (True, False, True, "fail", True), (True, True, True, "ok", True), (True, True, True, "ok", False), (True, True, None, " FAIL ", False)]
    df = spark.createDataFrame(reports, "w boolean, s boolean, c boolean, v string, h boolean")
    assert [r[0] for r in df.select(V.report_error(*map(F.col, "wscvh"))).collect()] == [None, "not_well_posed", "unsound", "counterexample", None, "failed"]


def test_rotation_goes_on_over_slots():
    seeds = ["a", "b", "c", "d", "b"]
    got = rotated(seeds, {"c": "n2", "d": "n1"}, [("easy", []), ("hard", ["n2"]), ("medium", ["n1"]), ("medium", [])], ["n1", "n2"])
    assert got == [["a"], ["b", "c", "d"], ["c", "d"], ["d", "c"]]
    assert rotated([], {}, [("easy", ["x"])], []) == [[]]


def test_keep_first_and_rate_guard(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (2, 1, None), (None, 3, "x"), (None, 2, "y")], "k int, t int, v string")
    assert sorted((r.k or 0, r.v) for r in R.keep_first(df, ["k"], [F.col("t"), F.col("v")]).collect()) == [(0, "y"), (1, "a"), (2, None)]
    assert R.check_rate(1, 10, 0.1) == 0.1 and R.check_rate(0, 0, 0) == 0
    with pytest.raises(ValueError, match="changes"):
        R.check_rate(2, 10, 0.1)


def test_queries_in_blocks_give_the_same(spark):
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 12)))
    docs = spark.createDataFrame([(i, text()) for i in range(80)] + [(900, None)], "d long, x string").repartition(3)
    asked = spark.createDataFrame([(i, text()) for i in range(12)] + [(90, None)], "q long, y string")
    words = lambda c: F.split(F.coalesce(c, F.lit("")), " ")
    top = lambda n: sorted((r.q, r["rank"], r.d, round(r.score, 9)) for r in S.bm25_top(docs, "d", words("x"), asked, "q", words("y"), 3, n).collect())
    assert top(None) == top(3) and top(None)
    near = lambda n: sorted((r.d, r.q, round(r.score, 9)) for r in S.copy_scores(docs, "d", "x", asked, "q", "y", 0.05, n).collect())
    assert near(None) == near(4) and near(None)


def test_coverage_starts_and_neighbourhood(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "d"), ("d", "d")], "src string, dst string")
    cover = spark.createDataFrame([("a", 9), ("b", 4), ("c", 3), ("x", 1)], "node string, cover long")
    starts = spark.createDataFrame([("x", 8)], "node string, starts long")
    got = coverage_starts(edges, cover, starts, edges.select(F.col("dst").alias("node"))).collect()
    assert {r.target for r in got} == {"d"} and {r.node for r in got} == {"a", "b", "c", "x"} and got[-1].node == "x"
    near = neighbourhood(spark.createDataFrame([("m", x) for x in "abc"] + [("c", "d"), ("y", "z")], "src string, dst string"), spark.createDataFrame([("b", 5)], "node string, freq long"))
    assert [(r.node, r.depth) for r in near.orderBy("rank").collect()] == [("m", 0), ("c", 1), ("b", 1), ("a", 1), ("d", 2)]


def test_outline_descriptions_and_rolling_shards(spark, tmp_path):
    lines = spark.createDataFrame([("11-XX Numbers",), ("11Axx Elementary",), (" 11A05  Factors ",), ("26A09 Lone",), ("",), (None,)], "value string")
    got = {r.code: (r.l1, r.l2, r.desc, r.l1_desc, r.l2_desc) for r in files.outline_catalogue(lines).collect()}
    assert got == {"11A05": ("11", "11Axx", "Factors", "Numbers", "Elementary"), "26A09": ("26", "26Axx", "Lone", "", "")}
    (tmp_path / "d.csv").write_text("code,desc\n 11a05 ,one\n11A05,two\n26A09, \n,x\n")
    assert [tuple(r) for r in files.read_descriptions(spark, str(tmp_path / "d.csv")).collect()] == [("11A05", "one")]
    assert files.read_descriptions(spark, str(tmp_path / "none.csv")).count() == 0
    out = str(tmp_path / "shards")
    assert files.append_rolling(spark.range(7).withColumn("x", F.lit(None).cast("string")), ["id"], out, rows=3) == 7
    assert files.append_rolling(spark.range(10, 14), ["id"], out, rows=3) == 11
    sizes = {r.shard: r["count"] for r in spark.read.json(out).groupBy("shard").count().collect()}
    assert sizes == {"shard_00001": 3, "shard_00002": 3, "shard_00003": 3, "shard_00004": 2}


def test_feedback_moves_on_to_uncovered_chains(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b", "d"]), (3, ["x", "y"]), (4, []), (5, ["x", "y"])], "id long, nodes array<string>")
    got = feedback_picks(df, 3)
    assert [(r, i) for r, i, _ in got] == [(1, 1), (2, 2), (3, 3)] and got[1][2] == pytest.approx(1 + 2 / 2**0.5)
    assert [i for _, i, _ in feedback_picks(df, 9)] == [1, 2, 3, 5]
    assert [i for _, i, _ in feedback_picks(df, 4, recent=0)] == [1, 2, 3, 1]
    assert feedback_picks(df.limit(0), 3) == []
