import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinworks.operators import graph as G
from skeinworks.operators import relational as R
from skeinworks.operators import similarity as S
from skeinworks.operators.components import connected_components


def components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in root}


@pytest.mark.parametrize("n,m", [(30, 12), (60, 55), (40, 200), (1, 3)])
def test_components(spark, n, m):
    rng = random.Random(n)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    got = connected_components(spark.createDataFrame(edges + [(None, 1), (2, None)], "a long, b long").repartition(5))
    assert sorted(map(tuple, got.collect())) == sorted(components(edges))


def test_components_of_a_long_path_and_strings(spark):
    path = [(i, i + 1) for i in range(300)]
    random.Random(1).shuffle(path)
    assert {r.component for r in connected_components(spark.createDataFrame(path, "a long, b long").repartition(7)).collect()} == {0}
    got = connected_components(spark.createDataFrame([("b", "a"), ("c", "b")], "a string, b string"))
    assert {tuple(r) for r in got.collect()} == {("a", "a"), ("b", "a"), ("c", "a")}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_dense_id(spark):
    rows = [(k,) for k in range(500)]
    random.Random(2).shuffle(rows)
    got = R.dense_id(spark.createDataFrame(rows, "k long").repartition(6), ["k"]).collect()
    assert all(r.k == r.position for r in got) and len(got) == 500
    assert R.dense_id(spark.createDataFrame([], "k long"), ["k"]).count() == 0


def test_mode_and_top(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("a", ""), ("a", ""), ("a", ""), ("b", "q"), ("b", "p"), ("c", None)], "k string, v string")
    assert {tuple(r) for r in R.mode_first(df, ["k"], "v").collect()} == {("a", "y"), ("b", "p")}
    assert R.top_k(df.filter("v <> ''"), ["k"], [F.col("v")], 1).count() == 2


def test_largest_remainder(spark):
    def shares(total, parts):
        df = spark.createDataFrame([("g", total, s, i) for i, s in enumerate(parts)], "g string, total int, share double, p int")
        return [r.allocated for r in R.largest_remainder(df, ["g"], "total", "share", "p").orderBy("p").collect()]

    assert shares(10, [0.3, 0.3, 0.4]) == [3, 3, 4]
    assert shares(1, [0.4, 0.3, 0.3]) == [1, 0, 0]
    assert sum(shares(0, [0.4, 0.3, 0.3])) == 1


@pytest.mark.parametrize("seed,cap", [(1, 1), (2, 2), (3, 3)])
def test_degree_cap_is_greedy(spark, seed, cap):
    rng = random.Random(seed)
    edges = [(a, b, rng.randrange(5) / 4) for a, b in itertools.combinations(range(9), 2) if rng.random() < 0.7]
    got = {(r.src, r.dst) for r in R.degree_capped(spark.createDataFrame(edges, "src int, dst int, conf double"), cap, [-F.col("conf"), F.col("src"), F.col("dst")]).collect()}
    free, want = defaultdict(lambda: cap), set()
    for a, b, c in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        if free[a] and free[b]:
            free[a] -= 1
            free[b] -= 1
            want.add((a, b))
    assert got == want


def test_remap_and_conform(spark):
    df = spark.createDataFrame([("a", "b"), ("c", None)], "src string, dst string")
    m = spark.createDataFrame([("a", "z")], "old_id string, new_id string")
    assert {tuple(r) for r in R.remap(df, m, ["src", "dst"]).select("src", "dst").collect()} == {("z", "b"), ("c", None)}
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.StringType())])
    got = R.conform(spark.createDataFrame([("1.5",), ("bad",), (None,)], "x string"), schema, {"x": 0.0, "y": ""})
    assert [tuple(r) for r in got.collect()] == [(1.5, ""), (0.0, ""), (0.0, "")]


def test_prerequisites_and_cycles(spark):
    pairs = spark.createDataFrame([("p", "a", "b", 3, 0.5, 0.1, 0.4), ("p", "a", "c", 0, 0.1, 0.1, 0.9), ("p", "b", "c", 9, 0.0, 0.5, 0.5), ("p", "b", "d", 9, 0.0, 0.9, 0.5)], "parent string, a string, b string, cooccur int, sim double, da double, db double")
    got = {(r.src, r.dst): r.conf for r in G.prerequisite_edges(pairs, 3, 0.3, 0.1).collect()}
    assert set(got) == {("a", "b"), ("d", "b")} and abs(got["a", "b"] - (0.35 + 0.175 + 0.3)) < 1e-9
    edges = spark.createDataFrame([("g", "a", "b", 0.9), ("g", "b", "c", 0.5), ("g", "c", "a", 0.7), ("g", "c", "d", 0.1), ("h", "x", "y", 0.2), ("h", "y", "x", 0.3)], "grp string, src string, dst string, conf double")
    assert {(r.src, r.dst) for r in G.drop_cycles(edges, "grp").collect()} == {("a", "b"), ("c", "a"), ("c", "d"), ("y", "x")}


def test_depths_and_gain(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (5, 1)], "src int, dst int")
    one = spark.createDataFrame([(1,)], "node int")
    assert {tuple(r) for r in G.depths(e, one, 2).collect()} == {(1, 0), (2, 1), (5, 1), (3, 2)}
    assert {tuple(r) for r in G.depths(e, one, 5, directed=True, backwards=True).collect()} == {(1, 0), (5, 1)}
    cover = spark.createDataFrame([(2, 3)], "node int, cover int")
    gain = {r.node: r.gain for r in G.forward_gain(e, cover, 2).collect()}
    assert abs(gain[1] - (1 + 0.5 / 2 + 1 / 3)) < 1e-9 and gain[4] == 1


def test_beam_never_repeats_and_takes_one_main(spark):
    rng = random.Random(4)
    edges = [(a, b, rng.choice(["pre", "sem", "main_sem"]), rng.randrange(20) / 20, rng.randrange(9)) for a in range(8) for b in range(8) if a != b and rng.random() < 0.5]
    df = spark.createDataFrame(edges, "src int, dst int, type string, conf double, cooccur int")
    got = G.beam_chains(df, df.select(F.col("src").alias("node")).distinct(), 4, 3).collect()
    assert got
    for r in got:
        assert len(set(r.chain)) == len(r.chain) and r.types.count("main_sem") <= 1 and r["rank"] <= 3


def test_entropy(spark):
    df = spark.createDataFrame([([1, 1],), ([5],), ([3, 1],)], "c array<int>")
    got = [r[0] for r in df.select(G.normalised_entropy(F.col("c"))).collect()]
    assert abs(got[0] - 1) < 1e-9 and got[1] == 0 and 0 < got[2] < 1


def test_bm25_top_like_brute_force(spark):
    import math

    rng = random.Random(6)
    docs = [(i, [f"t{rng.randrange(12)}" for _ in range(rng.randrange(0, 15))]) for i in range(60)]
    queries = [(i, [f"t{rng.randrange(14)}" for _ in range(4)]) for i in range(5)]
    n, avg = len(docs), sum(len(t) for _, t in docs) / len(docs)
    df = lambda t: sum(t in d for _, d in docs)
    score = lambda q, d: sum(math.log(1 + (n - df(t) + 0.5) / (df(t) + 0.5)) * d.count(t) * 2.5 / (d.count(t) + 1.5 * (0.25 + 0.75 * len(d) / avg)) for t in q if t in d)
    got = S.bm25_top(spark.createDataFrame(docs, "d int, t array<string>").repartition(4), "d", F.col("t"), spark.createDataFrame(queries, "q int, t array<string>"), "q", F.col("t"), 3).collect()
    for q, ts in queries:
        want = sorted(((-round(s, 9), d) for d, t in docs if (s := score(ts, t)) > 0))[:3]
        mine = sorted((-round(r.score, 9), r.d) for r in got if r.q == q)
        assert [d for _, d in mine] == [d for _, d in want]


def test_char_grams(spark):
    got = spark.createDataFrame([("ab cde",)], "x string").select(S.char_grams(F.col("x"))).first()[0]
    assert sorted(got) == sorted([" ab", "ab ", " ab ", " cd", "cde", "de ", " cde", "cde ", " cde "])


def test_rewrite_and_merge(spark):
    nodes = spark.createDataFrame([("a", 1, "x"), ("b", 5, "x"), ("c", 5, "xyz"), ("d", 9, "q")], "id string, freq int, text string")
    m = G.homogeneous_merge(nodes, spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string"))
    assert {tuple(r) for r in m.collect()} == {("a", "c", 3), ("b", "c", 3), ("c", "c", 3), ("d", "d", 1)}
    e = spark.createDataFrame([("a", "d", 0.2, 3, 0.5), ("b", "d", 0.4, 1, 0.1), ("a", "b", 0.9, 9, 0.9)], "src string, dst string, conf double, cooccur int, gap double")
    assert [tuple(r) for r in G.rewrite_edges(e, m).collect()] == [("c", "d", 0.4, 3, 0.1)]


def test_undirected_anti(spark):
    c = spark.createDataFrame([("a", "b"), ("a", "c")], "a string, b string")
    e = spark.createDataFrame([("b", "a"), ("c", "c")], "src string, dst string")
    assert [tuple(r) for r in G.undirected_anti(c, e).select("a", "b").collect()] == [("a", "c")]


def test_softmax_odds_and_seeded_order(spark):
    from skeinworks.operators.sampling import shuffled_first, softmax_choice

    df = spark.range(4000).selectExpr("id AS g", "explode(array('a', 'b')) AS x").selectExpr("g", "x", "if(x = 'a', ln(3), 0.0) AS s")
    n = softmax_choice(df, ["g"], "x", "s", 1.0, 1).filter("x = 'a'").count()
    assert abs(n / 4000 - 0.75) < 0.03
    rows = spark.range(50).selectExpr("id % 2 AS g", "id AS x")
    one, two = ({tuple(r) for r in shuffled_first(rows.repartition(k), ["g"], "x", 3, 5).collect()} for k in (1, 6))
    assert one == two and len(one) == 6


def test_clusters(spark):
    from skeinworks.operators.sampling import cluster_groups

    words = [("g", f"{a} {b}", 1) for a in ("red", "blue", "green") for b in ("sum", "area", "ratio", "bound")] + [("h", "x y", 1), ("h", "z", 2)]
    df = spark.createDataFrame(words, "g string, c string, f int").withColumn("t", F.array(F.substring_index("c", " ", 1)))
    got = cluster_groups(df, "g", "c", "t", "f", 3).collect()
    assert len({(r.c.split()[0], r.cluster) for r in got if r.g == "g"}) == 3
    assert len({r.cluster for r in got if r.g == "h"}) == 2
