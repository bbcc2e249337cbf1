"""Where to start a chain and what to show of a graph: bridges, coverage, neighbourhoods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.operators import graph as G
from skeinworks.operators import relational as R
from skeinworks.operators.components import connected_components
from skeinworks.plans.graphs import CHAIN_SQL, chain_edges, chain_steps, doc_terms, subnodes
from skeinworks.plans.planning import chain_score
from skeinworks.plans.registry import SQL, query
from skeinworks.plans.texts import norm_sql
from skeinworks.runtime import materialize, table

HOPS, TOP_STARTS, NEAR, MOST_NODES = 3, 32, 2, 40

BRIDGE_SQL = "WITH RECURSIVE " + CHAIN_SQL + f""", sn AS (SELECT subnode_id AS id, parent_node_id AS parent, coalesce(freq, 0) AS freq, concat_ws(' ', coalesce(msc_full, ''), coalesce(concept_cluster, '')) AS doc FROM subnodes),
tk AS (SELECT id, parent, list_distinct(CASE WHEN len(t) > 0 THEN t ELSE ['math'] END) AS t FROM (SELECT id, parent, regexp_extract_all({norm_sql('doc')}, '[a-z0-9]+') AS t FROM sn)),
pm AS (SELECT x.parent AS src, y.parent AS dst, avg(conf) AS conf FROM chain_edges e JOIN sn x ON x.id = e.src JOIN sn y ON y.id = e.dst WHERE type = 'main_sem' AND x.parent <> y.parent GROUP BY ALL),
p3 AS (SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(conf, 9) DESC, dst) AS r FROM pm) WHERE r <= 3),
bp AS (SELECT a.id AS node, p3.dst AS target, b.id AS best, len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t)))::DOUBLE AS score, row_number() OVER (PARTITION BY a.id, p3.dst ORDER BY round(len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t)))::DOUBLE, 9) DESC, b.id) AS r FROM tk a JOIN p3 ON p3.src = a.parent JOIN tk b ON b.parent = p3.dst),
cov_edges AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM chain_edges WHERE type <> 'main_sem' UNION ALL SELECT node, best FROM bp WHERE r = 1) WHERE src <> dst)
"""


def bridge_picks(spark, sf_dir: str) -> DataFrame:
    """node, target, best, score: for each subnode and each of its parent's three surest neighbours, the neighbour's subnode most alike in words.

    Pairs come from shared words; a neighbour none of whose subnodes shares a word gives its first one, with a score of 0.
    """
    s = subnodes(spark, sf_dir)
    of = s.select("id", "parent")
    main = chain_edges(spark, sf_dir).filter("type = 'main_sem'").select("src", "dst", "conf")
    main = main.join(of.select(F.col("id").alias("src"), F.col("parent").alias("ps")), "src").join(of.select(F.col("id").alias("dst"), F.col("parent").alias("pd")), "dst").filter("ps <> pd")
    best3 = R.top_k(main.groupBy("ps", "pd").agg(F.avg("conf").alias("conf")), ["ps"], [F.round("conf", 9).desc(), F.col("pd")], 3).select("ps", "pd")
    words = s.select("id", "parent", F.array_distinct(doc_terms()).alias("t")).select("id", "parent", F.size("t").alias("n"), F.explode("t").alias("w"))
    left = words.join(best3.withColumnRenamed("ps", "parent"), "parent").select(F.col("id").alias("node"), F.col("pd").alias("target"), F.col("n").alias("n1"), "w")
    right = words.select(F.col("id").alias("best"), F.col("parent").alias("target"), F.col("n").alias("n2"), "w")
    shared = left.join(right, ["target", "w"]).groupBy("node", "target", "best", "n1", "n2").agg(F.count("*").alias("k"))
    scored = shared.select("node", "target", "best", (F.col("k") / (F.col("n1") + F.col("n2") - F.col("k"))).alias("score"))
    top = scored.groupBy("node", "target").agg(F.min_by(F.struct("best", "score"), F.struct(-F.round("score", 9), F.col("best"))).alias("b"))
    first = s.groupBy(F.col("parent").alias("target")).agg(F.min("id").alias("first"))
    every = s.select(F.col("id").alias("node"), F.col("parent").alias("ps")).join(best3.withColumnRenamed("pd", "target"), "ps").join(first, "target").join(top, ["node", "target"], "left")
    return every.select("node", "target", F.coalesce("b.best", "first").alias("best"), F.coalesce("b.score", F.lit(0.0)).alias("score"))


def cover_edges(spark, sf_dir: str) -> DataFrame:
    """src, dst: pre and semantic edges, and each subnode's bridges."""
    e = chain_edges(spark, sf_dir).filter("type <> 'main_sem'").select("src", "dst")
    b = bridge_picks(spark, sf_dir).select(F.col("node").alias("src"), F.col("best").alias("dst"))
    return e.unionByName(b).filter("src <> dst").distinct()


@query("bridge_picks", BRIDGE_SQL + "SELECT node, target, best, round(score, 6) AS score FROM bp WHERE r = 1")
def bridge_picks_query(spark, sf_dir: str) -> DataFrame:
    return bridge_picks(spark, sf_dir).withColumn("score", F.round("score", 6))


@query("cover_edges", BRIDGE_SQL + "SELECT coalesce(o.node, i.node) AS node, coalesce(onward, '') AS onward, coalesce(back, '') AS back FROM (SELECT src AS node, string_agg(dst, ',' ORDER BY dst) AS onward FROM cov_edges GROUP BY src) o FULL JOIN (SELECT dst AS node, string_agg(src, ',' ORDER BY src) AS back FROM cov_edges GROUP BY dst) i ON i.node = o.node")
def cover_edges_query(spark, sf_dir: str) -> DataFrame:
    """Each subnode's neighbours onward and, the table inverted, back."""
    e = materialize(cover_edges(spark, sf_dir), "cover")
    side = lambda a, b, name: e.groupBy(F.col(a).alias("node")).agg(F.array_join(F.array_sort(F.collect_set(b)), ",").alias(name))
    return side("src", "dst", "onward").join(side("dst", "src", "back"), "node", "full").fillna("", ["onward", "back"])


def coverage_starts(edges: DataFrame, cover: DataFrame, starts: DataFrame, nodes: DataFrame, hops: int = HOPS, k: int = TOP_STARTS) -> DataFrame:
    """target, node, score, rank: the k best starts towards the node that fewest chains pass.

    edges: src, dst. cover, starts: node and how many chains pass it or start there. nodes: node. Starts are the nodes that reach the
    target within hops steps (the target itself if there is none); their score is what they may gain within hops steps over
    the root of one more than their chains. Softmax choices over these scores are made by operators.sampling.
    """
    seen = nodes.select("node").distinct().join(cover, "node", "left").select("node", F.coalesce("cover", F.lit(0)).alias("cover"))
    target = materialize(seen.orderBy("cover", "node").limit(1).select("node"), "target")
    back = G.depths(edges, target, hops, directed=True, backwards=True).filter("depth > 0").select("node")
    back = back.unionByName(target) if back.isEmpty() else back
    gain = G.forward_gain(edges, cover, hops)
    scored = back.join(gain, "node", "left").join(starts, "node", "left").select("node", (F.coalesce("gain", F.lit(0.0)) / F.sqrt(1 + F.coalesce("starts", F.lit(0)))).alias("score"))
    best = scored.orderBy(F.round("score", 9).desc(), "node").limit(k)  # the k rows ranked below
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(F.round("score", 9).desc(), "node")))
    return ranked.join(F.broadcast(target.withColumnRenamed("node", "target")), how="cross").select("target", "node", "score", "rank")


@query("coverage_start", "WITH RECURSIVE " + CHAIN_SQL + f""", ed AS (SELECT DISTINCT src, dst FROM chain_edges WHERE type = 'pre' AND conf >= 0.8),
cv AS (SELECT node, count(*) AS cover FROM (SELECT synth_id, src AS node FROM good UNION SELECT synth_id, dst FROM good) GROUP BY node),
sc AS (SELECT trim(chain_subnodes[1]) AS node, count(*) AS starts FROM synth_refill WHERE trim(chain_subnodes[1]) <> '' GROUP BY 1),
nd AS (SELECT src AS node FROM ed UNION SELECT dst FROM ed),
tg AS (SELECT dst AS node FROM ed LEFT JOIN cv ON cv.node = dst ORDER BY coalesce(cover, 0), dst LIMIT 1),
bf AS (SELECT node, 0 AS depth FROM tg UNION SELECT ed.src, depth + 1 FROM bf JOIN ed ON ed.dst = bf.node WHERE depth < {HOPS}),
bk AS (SELECT node, min(depth) AS depth FROM bf GROUP BY node),
rf AS (SELECT node AS start, node, 0 AS d FROM nd UNION SELECT r.start, ed.dst, r.d + 1 FROM rf r JOIN ed ON ed.src = r.node WHERE r.d < {HOPS}),
gn AS (SELECT start AS node, sum(1 / (d + 1)::DOUBLE / sqrt(1 + coalesce(cover, 0))) AS gain FROM (SELECT start, node, min(d) AS d FROM rf GROUP BY start, node) m LEFT JOIN cv ON cv.node = m.node GROUP BY start),
s AS (SELECT bk.node, coalesce(gain, 0) / sqrt(1 + coalesce(starts, 0)) AS score FROM bk LEFT JOIN gn USING (node) LEFT JOIN sc USING (node) WHERE depth > 0)
SELECT (SELECT node FROM tg) AS target, node, round(score, 6) AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, node) AS rank FROM s) WHERE rank <= {TOP_STARTS}""")
def coverage_start(spark, sf_dir: str) -> DataFrame:
    """The best starts towards the least covered node along sure prerequisite edges (a top-k report)."""
    edges = materialize(chain_edges(spark, sf_dir).filter("type = 'pre' and conf >= 0.8").select("src", "dst").distinct(), "sure")
    passed = chain_steps(spark, sf_dir).select("synth_id", F.explode(F.array("src", "dst")).alias("node")).distinct()
    first = table(spark, sf_dir, "synth_refill").select(F.trim(F.get("chain_subnodes", 0)).alias("node")).filter("node <> ''")
    got = coverage_starts(edges, passed.groupBy("node").agg(F.count("*").alias("cover")), first.groupBy("node").agg(F.count("*").alias("starts")), edges.select(F.col("dst").alias("node")))
    return got.withColumn("score", F.round("score", 6))


def neighbourhood(edges: DataFrame, freq: DataFrame, hops: int = NEAR, most: int = MOST_NODES) -> DataFrame:
    """node, depth, rank: the nodes about the one with most edges, the nearest first, as far as they hang together.

    edges: src, dst (undirected). Ranked by steps from the centre, then edges, then freq, then id; of the first most nodes those
    without an edge among them go, and of the others the centre's component stays.
    """
    pairs = materialize(edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).filter("src <> dst").distinct(), "near-edges")
    degree = G.degrees(pairs)
    centre = materialize(degree.orderBy(F.col("degree").desc(), "node").limit(1).select("node"), "near-centre")
    near = G.depths(pairs, centre, hops).join(degree, "node", "left").join(freq, "node", "left")
    order = [F.col("depth"), F.coalesce("degree", F.lit(0)).desc(), F.coalesce("freq", F.lit(0)).desc(), F.col("node")]
    kept = materialize(near.orderBy(*order).limit(most).withColumn("rank", F.row_number().over(Window.orderBy(*order))).select("node", "depth", "rank"), "near-kept")
    local = pairs.join(kept.select(F.col("node").alias("src")), "src", "left_semi").join(kept.select(F.col("node").alias("dst")), "dst", "left_semi")
    labels = connected_components(local)
    own = labels.join(centre, "node", "left_semi").select("component")
    return kept.join(labels.join(own, "component", "left_semi").select("node").unionByName(centre).distinct(), "node", "left_semi")


@query("neighbourhood", "WITH RECURSIVE " + CHAIN_SQL + f""", ed AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM chain_edges WHERE type = 'sem' AND conf >= 0.8),
li AS (SELECT src AS u, dst AS v FROM ed UNION ALL SELECT dst, src FROM ed),
dg AS (SELECT u AS node, count(*) AS degree FROM li GROUP BY u),
ce AS (SELECT node FROM dg ORDER BY degree DESC, node LIMIT 1),
bf AS (SELECT node, 0 AS depth FROM ce UNION SELECT li.v, depth + 1 FROM bf JOIN li ON li.u = bf.node WHERE depth < {NEAR}),
nr AS (SELECT node, min(depth) AS depth FROM bf GROUP BY node),
kp AS (SELECT node, depth, row_number() OVER (ORDER BY depth, degree DESC, coalesce(freq, 0) DESC, node) AS rank FROM nr LEFT JOIN dg USING (node) LEFT JOIN (SELECT subnode_id AS node, max(freq) AS freq FROM subnodes GROUP BY subnode_id) f USING (node)),
k AS (SELECT * FROM kp WHERE rank <= {MOST_NODES}),
lo AS (SELECT u, v FROM li WHERE u IN (SELECT node FROM k) AND v IN (SELECT node FROM k)),
rc AS (SELECT node FROM ce UNION SELECT lo.v FROM rc JOIN lo ON lo.u = rc.node)
SELECT node, depth::INT AS depth, rank::INT AS rank FROM k WHERE node IN (SELECT node FROM rc)""")
def neighbourhood_query(spark, sf_dir: str) -> DataFrame:
    """What a picture of the sure semantic edges about their centre would show."""
    freq = table(spark, sf_dir, "subnodes").groupBy(F.col("subnode_id").alias("node")).agg(F.max("freq").alias("freq"))
    return neighbourhood(chain_edges(spark, sf_dir).filter("type = 'sem' and conf >= 0.8"), freq)


@query("candidate_pick", f"SELECT * FROM (SELECT synth_id, score, row_number() OVER (ORDER BY score DESC, synth_id)::INT AS rank FROM ({SQL['chain_score']})) WHERE rank <= 8")
def candidate_pick(spark, sf_dir: str) -> DataFrame:
    """The eight best chains (a top-k report); operators.sampling chooses among them at random."""
    best = chain_score(spark, sf_dir).orderBy(F.col("score").desc(), "synth_id").limit(8)
    return best.select("synth_id", "score", F.row_number().over(Window.orderBy(F.col("score").desc(), "synth_id")).alias("rank"))


ROUNDS = 12


@query("feedback_picks", "WITH RECURSIVE " + CHAIN_SQL + f""", ch AS MATERIALIZED (SELECT synth_id AS id, list_sort(list_distinct(list(node))) AS nodes FROM (SELECT synth_id, src AS node FROM good UNION ALL SELECT synth_id, dst FROM good) GROUP BY synth_id),
g AS (SELECT 0 AS r, NULL::BIGINT AS id, NULL::DOUBLE AS score, MAP {{}}::MAP(VARCHAR, INT) AS taken, []::BIGINT[] AS gone
  UNION ALL SELECT r, id, score, map_from_entries(list_transform(list_distinct(list_concat(map_keys(taken), nodes)), lambda n: (n, coalesce(taken[n], 0) + list_contains(nodes, n)::INT))), list_append(gone, id)
  FROM (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS k FROM (SELECT g.r + 1 AS r, ch.id, ch.nodes, g.taken, g.gone, round(list_sum(list_transform(ch.nodes, lambda n: 1 / sqrt(1 + coalesce(g.taken[n], 0)))), 9) AS score FROM g, ch WHERE g.r < {ROUNDS} AND NOT list_contains(g.gone, ch.id))) WHERE k = 1)
SELECT r::INT AS round, id AS synth_id, round(score, 6) AS score FROM g WHERE r > 0""")
def feedback_picks_query(spark, sf_dir: str) -> DataFrame:
    """Twelve chains in turn, each the best for what the ones before it left uncovered (a top-k report)."""
    from skeinworks.operators.sampling import feedback_picks

    ends = chain_steps(spark, sf_dir).select("synth_id", F.explode(F.array("src", "dst")).alias("node"))
    chains = materialize(ends.groupBy(F.col("synth_id").alias("id")).agg(F.array_sort(F.collect_set("node")).alias("nodes")), "chains")
    return spark.createDataFrame(feedback_picks(chains, ROUNDS), "round int, synth_id long, score double").withColumn("score", F.round("score", 6))
