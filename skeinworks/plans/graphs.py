"""Edges, merges, traversals, chains and allocations of the concept graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.functions import text as T
from skeinworks.operators import graph as G
from skeinworks.operators import relational as R
from skeinworks.operators import similarity as S
from skeinworks.operators.components import connected_components
from skeinworks.plans.registry import query
from skeinworks.plans.seeds import INDEX_SQL, seed_index, subnode_difficulty
from skeinworks.plans.texts import norm_sql
from skeinworks.runtime import materialize, table

MIN_COOCCUR, MIN_SIM, MIN_GAP = 3, 0.35, 0.005


def subnodes(spark, sf_dir: str) -> DataFrame:
    """id, parent, doc (what similarity is computed on), domain, freq; the first row of each id."""
    s = table(spark, sf_dir, "subnodes")
    doc = F.concat_ws(" ", F.coalesce("msc_full", F.lit("")), F.coalesce("concept_cluster", F.lit("")))
    return s.select(F.col("subnode_id").alias("id"), F.col("parent_node_id").alias("parent"), doc.alias("doc"), "concept_cluster", "domain", "freq")


def doc_terms():
    t = T.tokens(F.col("doc"))
    return F.when(F.size(t) > 0, t).otherwise(F.array(F.lit("math")))


BASE_SQL = "WITH RECURSIVE " + INDEX_SQL + f""",
sn AS (SELECT subnode_id AS id, parent_node_id AS parent, concat_ws(' ', coalesce(msc_full, ''), coalesce(concept_cluster, '')) AS doc, concept_cluster, domain, freq FROM subnodes),
toks AS (SELECT id, CASE WHEN len(t) > 0 THEN t ELSE ['math'] END AS t FROM (SELECT id, regexp_extract_all({norm_sql('doc')}, '[a-z0-9]+') AS t FROM sn)),
bn AS (SELECT count(*) AS n, greatest(1.0, sum(len(t)) / count(*)) AS avgdl FROM toks),
tf AS (SELECT id, len(t) AS dl, term, count(*) AS tf FROM (SELECT id, t, unnest(t) AS term FROM toks) GROUP BY ALL),
idf AS (SELECT term, ln(1 + (any_value(bn.n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, bn GROUP BY term),
w AS (SELECT id, tf.term, tf, idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl)) AS w FROM tf JOIN idf USING (term), bn),
selfs AS (SELECT id, sum(tf * w) AS s FROM w GROUP BY id),
dir AS (SELECT x.id AS a, y.id AS b, sum(x.tf * y.w) AS ab, sum(y.tf * x.w) AS ba FROM w x JOIN w y ON x.term = y.term AND x.id <> y.id GROUP BY ALL),
sims AS (SELECT a, b, greatest(0, least(1, (ab / sa.s + ba / sb.s) / 2)) AS sim FROM dir JOIN selfs sa ON sa.id = a JOIN selfs sb ON sb.id = b),
d AS (SELECT subnode_id AS id, avg(coalesce((try_cast(regexp_extract(lower(s.level), '([1-5])', 1) AS DOUBLE) - 1) / 4, 0.5)) AS d FROM idx LEFT JOIN math_seed s USING (qid) GROUP BY subnode_id),
pairs AS (SELECT x.parent, x.id AS a, y.id AS b FROM sn x JOIN sn y ON x.parent = y.parent AND x.id < y.id),
co AS (SELECT p.a, p.b, count(*) AS k FROM pairs p JOIN idx x ON x.subnode_id = p.a JOIN idx y ON y.subnode_id = p.b AND y.qid = x.qid GROUP BY ALL),
full_pairs AS (SELECT p.parent, p.a, p.b, coalesce(co.k, 0) AS cooccur, coalesce(sims.sim, 0) AS sim, coalesce(da.d, 0.5) AS da, coalesce(db.d, 0.5) AS db
  FROM pairs p LEFT JOIN co ON co.a = p.a AND co.b = p.b LEFT JOIN sims ON sims.a = p.a AND sims.b = p.b LEFT JOIN d da ON da.id = p.a LEFT JOIN d db ON db.id = p.b),
ev AS (SELECT *, db - da AS gap FROM full_pairs WHERE (cooccur >= {MIN_COOCCUR} OR sim >= {MIN_SIM}) AND abs(db - da) >= {MIN_GAP}),
pre AS (SELECT parent, CASE WHEN gap > 0 THEN a ELSE b END AS src, CASE WHEN gap > 0 THEN b ELSE a END AS dst,
  0.35 * least(1.0, cooccur / 3) + 0.35 * sim + 0.30 * least(1.0, abs(gap) / {MIN_GAP}) AS conf, cooccur, sim, abs(gap) AS gap FROM ev),
"""


def full_pairs(spark, sf_dir: str) -> DataFrame:
    """Same-parent pairs with shared seeds, similarity and both difficulties."""
    s = subnodes(spark, sf_dir)
    pairs = R.pairs_within(s, "parent", "id")
    counted = R.cooccurrence_counts(pairs, seed_index(spark, sf_dir), "subnode_id", "qid")
    sims = S.bm25_pairs(s, "id", doc_terms(), pairs)
    d = subnode_difficulty(spark, sf_dir)
    out = counted.join(sims, ["a", "b"], "left").withColumn("sim", F.coalesce("sim", F.lit(0.0)))
    for end in ("a", "b"):
        out = out.join(d.select(F.col("subnode_id").alias(end), F.col("d").alias(f"d{end}")), end, "left").withColumn(f"d{end}", F.coalesce(f"d{end}", F.lit(0.5)))
    return out


def prerequisites(spark, sf_dir: str) -> DataFrame:
    return G.prerequisite_edges(full_pairs(spark, sf_dir), MIN_COOCCUR, MIN_SIM, MIN_GAP)


ROUNDED = "round(conf, 6) AS conf, cooccur, round(sim, 6) AS sim, round(gap, 6) AS gap"


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("pair_cooccur", BASE_SQL + "z AS (SELECT 1) SELECT a, b, cooccur FROM full_pairs WHERE cooccur > 0")
def pair_cooccur(spark, sf_dir: str) -> DataFrame:
    pairs = R.pairs_within(subnodes(spark, sf_dir), "parent", "id")
    return R.cooccurrence_counts(pairs, seed_index(spark, sf_dir), "subnode_id", "qid").filter("cooccur > 0").select("a", "b", "cooccur")


@query("bm25_symmetric", BASE_SQL + "z AS (SELECT 1) SELECT a, b, round(sim, 6) AS sim FROM sims JOIN pairs USING (a, b)")
def bm25_symmetric(spark, sf_dir: str) -> DataFrame:
    s = subnodes(spark, sf_dir)
    return _rounded(S.bm25_pairs(s, "id", doc_terms(), R.pairs_within(s, "parent", "id")), "sim")


@query("pre_edges", BASE_SQL + f"z AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(conf, 9) DESC, round(sim, 9) DESC, cooccur DESC, dst) AS rank FROM pre) SELECT parent, src, dst, {ROUNDED}, rank::INT AS rank FROM z WHERE rank <= 3")
def pre_edges(spark, sf_dir: str) -> DataFrame:
    """Each subnode's three surest prerequisite edges."""
    order = [F.round("conf", 9).desc(), F.round("sim", 9).desc(), F.col("cooccur").desc(), F.col("dst")]
    return _rounded(R.top_k(prerequisites(spark, sf_dir), ["src"], order, 3), "conf", "sim", "gap")


@query("pre_edges_acyclic", BASE_SQL + "z AS (SELECT 1) SELECT parent, count(*) AS edges, round(min(conf), 6) AS least FROM pre GROUP BY parent")
def pre_edges_acyclic(spark, sf_dir: str) -> DataFrame:
    """Edges left of each parent once no cycle is: its edges, and its surest one turned round as the weakest of all.

    Climbing a difficulty, the edges have no cycle of their own; each turned one closes one, and must be the edge that goes.
    """
    edges = materialize(prerequisites(spark, sf_dir).select("parent", "src", "dst", "conf"), "climbing")
    surest = R.top_k(edges, ["parent"], [F.round("conf", 9).desc(), F.col("src"), F.col("dst")], 1)
    turned = surest.select("parent", F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(0.0).alias("conf"))
    kept = G.drop_cycles(edges.unionByName(turned), "parent")
    return kept.groupBy("parent").agg(F.count("*").alias("edges"), F.round(F.min("conf"), 6).alias("least"))


SEM_SQL = """sem AS (SELECT * FROM (SELECT parent, a AS src, b AS dst, cooccur, sim, row_number() OVER (ORDER BY cooccur DESC, round(sim, 9) DESC, a, b) AS r
  FROM full_pairs f WHERE NOT EXISTS (SELECT 1 FROM pre p WHERE least(p.src, p.dst) = f.a AND greatest(p.src, p.dst) = f.b)) WHERE r <= 160),
"""


@query("sem_sub_edges", BASE_SQL + SEM_SQL + "z AS (SELECT 1) SELECT parent, src, dst, cooccur, round(sim, 6) AS sim FROM sem")
def sem_sub_edges(spark, sf_dir: str) -> DataFrame:
    """The 160 same-parent pairs that share most seeds without being prerequisites."""
    pairs = materialize(full_pairs(spark, sf_dir), "full-pairs")
    left = G.undirected_anti(pairs, G.prerequisite_edges(pairs, MIN_COOCCUR, MIN_SIM, MIN_GAP))
    best = left.orderBy(F.col("cooccur").desc(), F.round("sim", 9).desc(), "a", "b").limit(160)
    return best.select("parent", F.col("a").alias("src"), F.col("b").alias("dst"), "cooccur", F.round("sim", 6).alias("sim"))


@query("cooccur_quantile", BASE_SQL + "z AS (SELECT 1) SELECT parent, count(*) AS pairs, round(quantile_cont(cooccur, 0.25), 6) AS p25, max(cooccur) AS most FROM full_pairs GROUP BY parent")
def cooccur_quantile(spark, sf_dir: str) -> DataFrame:
    pairs = R.pairs_within(subnodes(spark, sf_dir), "parent", "id")
    c = R.cooccurrence_counts(pairs, seed_index(spark, sf_dir), "subnode_id", "qid")
    return c.groupBy("parent").agg(F.count("*").alias("pairs"), F.round(F.percentile("cooccur", 0.25), 6).alias("p25"), F.max("cooccur").alias("most"))


BRIDGE_SQL = """subj AS (SELECT DISTINCT subnode_id AS id, s.subject FROM idx JOIN math_seed s USING (qid) WHERE s.subject IS NOT NULL),
sn_n AS (SELECT id, count(*) AS n FROM subj GROUP BY id),
shared AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM subj x JOIN subj y ON x.subject = y.subject AND x.id <> y.id GROUP BY ALL),
cross_pairs AS (SELECT x.parent AS src, y.parent AS dst, x.id AS a, y.id AS b FROM sn x JOIN sn y ON x.parent < y.parent),
scored AS (SELECT src, dst, c.a, c.b, 0.7 * coalesce(sim, 0) + 0.3 * coalesce(k / (na.n + nb.n - k)::DOUBLE, 0) AS score
  FROM cross_pairs c LEFT JOIN sims ON sims.a = c.a AND sims.b = c.b LEFT JOIN shared ON shared.a = c.a AND shared.b = c.b LEFT JOIN sn_n na ON na.id = c.a LEFT JOIN sn_n nb ON nb.id = c.b),
ranked AS (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY round(score, 9) DESC, a, b) AS r FROM scored WHERE score > 0),
bridges AS (SELECT src, dst, count_if(score >= 0.45)::BIGINT AS bridge_count, avg(score) FILTER (WHERE r <= 3) AS topk_mean, max(score) AS best FROM ranked GROUP BY src, dst HAVING count_if(score >= 0.45) > 0),
"""


BRIDGE = 0.45


def bridges(spark, sf_dir: str) -> DataFrame:
    """src, dst, bridge_count, topk_mean, best of every two parents with a subnode pair above the threshold.

    Pairs without a common term stay below the threshold, so pairs are made from shared terms first; only parents that have a
    bridge by those are then compared whole, as their next best pairs count for the mean.
    """
    s = subnodes(spark, sf_dir)
    seeds_of = table(spark, sf_dir, "math_seed").select("qid", "subject").filter("subject is not null")
    subjects = materialize(seed_index(spark, sf_dir).join(seeds_of, "qid").groupBy("subnode_id").agg(F.collect_set("subject").alias("subjects")), "subjects")

    def scored(pairs: DataFrame) -> DataFrame:
        out = pairs.join(S.bm25_pairs(s, "id", doc_terms(), pairs.select("a", "b")), ["a", "b"], "left")
        for end in ("a", "b"):
            out = out.join(subjects.select(F.col("subnode_id").alias(end), F.col("subjects").alias(f"s{end}")), end, "left").withColumn(f"s{end}", F.coalesce(f"s{end}", F.array().cast("array<string>")))
        return out.select("src", "dst", "a", "b", G.bridge_score(F.coalesce("sim", F.lit(0.0)), T.jaccard(F.col("sa"), F.col("sb"))).alias("score")).filter("score > 0")

    words = s.select("id", "parent", F.explode(F.array_distinct(doc_terms())).alias("w"))
    x = words.select(F.col("id").alias("a"), F.col("parent").alias("src"), "w")
    y = words.select(F.col("id").alias("b"), F.col("parent").alias("dst"), "w")
    near = materialize(x.join(y, "w").filter("src < dst").select("src", "dst", "a", "b").distinct(), "bridge-pairs")
    good = materialize(scored(near).filter(f"score >= {BRIDGE}").select("src", "dst").distinct(), "bridge-parents")
    a, b = s.select(F.col("id").alias("a"), F.col("parent").alias("src")), s.select(F.col("id").alias("b"), F.col("parent").alias("dst"))
    scored = scored(materialize(good.join(a, "src").join(b, "dst"), "bridge-whole"))
    r = scored.withColumn("r", F.row_number().over(Window.partitionBy("src", "dst").orderBy(F.round("score", 9).desc(), "a", "b")))
    agg = r.groupBy("src", "dst").agg(F.count_if(F.col("score") >= BRIDGE).alias("bridge_count"), F.avg(F.when(F.col("r") <= 3, F.col("score"))).alias("topk_mean"), F.max("score").alias("best"))
    return agg.filter("bridge_count > 0")


@query("bridge_pairs", BASE_SQL + BRIDGE_SQL + "z AS (SELECT 1) SELECT src, dst, bridge_count, round(topk_mean, 6) AS topk_mean, round(best, 6) AS best FROM bridges")
def bridge_pairs(spark, sf_dir: str) -> DataFrame:
    return _rounded(bridges(spark, sf_dir), "topk_mean", "best")


CAPPED_SQL = BASE_SQL + BRIDGE_SQL + """o AS MATERIALIZED (SELECT src, dst, round(topk_mean, 6) AS conf, row_number() OVER (ORDER BY round(topk_mean, 6) DESC, src, dst) AS r FROM bridges),
g AS (SELECT 0::BIGINT AS r, MAP {}::MAP(VARCHAR, INT) AS deg, NULL::VARCHAR AS src, NULL::VARCHAR AS dst, NULL::DOUBLE AS conf, false AS kept
  UNION ALL SELECT o.r, CASE WHEN ok THEN map_concat(deg, MAP {o.src: coalesce(deg[o.src], 0) + 1, o.dst: coalesce(deg[o.dst], 0) + 1}) ELSE deg END, o.src, o.dst, o.conf, ok
  FROM (SELECT g.deg, o.*, coalesce(g.deg[o.src], 0) < 3 AND coalesce(g.deg[o.dst], 0) < 3 AS ok FROM g JOIN o ON o.r = g.r + 1) o)
SELECT src, dst, conf FROM g WHERE kept"""


@query("degree_capped", CAPPED_SQL)
def degree_capped(spark, sf_dir: str) -> DataFrame:
    """Bridges taken greedily by their mean while both parents have fewer than three."""
    b = bridges(spark, sf_dir).select("src", "dst", F.round("topk_mean", 6).alias("conf"))
    return R.degree_capped(b, 3, [-F.col("conf"), F.col("src"), F.col("dst")])


@query("centre_node", BASE_SQL + BRIDGE_SQL + """dg AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM bridges UNION ALL SELECT dst FROM bridges) GROUP BY node),
fr AS (SELECT parent AS node, sum(freq)::BIGINT AS freq FROM sn GROUP BY parent) SELECT node, degree, freq, (row_number() OVER (ORDER BY degree DESC, freq DESC, node))::INT AS rank FROM dg JOIN fr USING (node) ORDER BY rank LIMIT 10""")
def centre_node(spark, sf_dir: str) -> DataFrame:
    """The ten parents with most bridges (the first is the centre)."""
    dg = G.degrees(bridges(spark, sf_dir))
    fr = subnodes(spark, sf_dir).groupBy(F.col("parent").alias("node")).agg(F.sum("freq").alias("freq"))
    best = dg.join(fr, "node").orderBy(F.col("degree").desc(), F.col("freq").desc(), "node").limit(10)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col("degree").desc(), F.col("freq").desc(), "node")))


CHAIN_SQL = """steps AS (SELECT synth_id, trim(chain_subnodes[i]) AS src, trim(chain_subnodes[i + 1]) AS dst, edge_types[i] AS type, edge_confs[i] AS conf
  FROM (SELECT synth_id, chain_subnodes, edge_types, edge_confs, unnest(range(1, len(edge_types) + 1)) AS i FROM synth_refill WHERE len(chain_subnodes) = len(edge_types) + 1)),
good AS (SELECT * FROM steps WHERE src <> '' AND dst <> '' AND src <> dst AND type IS NOT NULL AND conf IS NOT NULL),
chain_edges AS (SELECT src, dst, type, avg(conf) AS conf, count(*) AS cooccur FROM good GROUP BY src, dst, type)
"""


def chain_steps(spark, sf_dir: str) -> DataFrame:
    """synth_id, src, dst, type, conf: the steps of every chain whose lists fit together."""
    s = table(spark, sf_dir, "synth_refill").filter(F.size("chain_subnodes") == F.size("edge_types") + 1)
    ends = F.arrays_zip(F.slice("chain_subnodes", F.lit(1), F.size("edge_types")).alias("s"), F.slice("chain_subnodes", F.lit(2), F.size("edge_types")).alias("d"), F.col("edge_types").alias("t"), F.col("edge_confs").alias("c"))
    rows = s.filter(F.size("edge_types") > 0).select("synth_id", F.explode(ends).alias("e")).select("synth_id", F.trim("e.s").alias("src"), F.trim("e.d").alias("dst"), F.col("e.t").alias("type"), F.col("e.c").alias("conf"))
    return rows.filter("src <> '' and dst <> '' and src <> dst and type is not null and conf is not null")


def chain_edges(spark, sf_dir: str) -> DataFrame:
    return chain_steps(spark, sf_dir).groupBy("src", "dst", "type").agg(F.avg("conf").alias("conf"), F.count("*").alias("cooccur"))


@query("chain_edges", "WITH " + CHAIN_SQL + "SELECT src, dst, type, round(conf, 6) AS conf, cooccur FROM chain_edges")
def chain_edges_query(spark, sf_dir: str) -> DataFrame:
    return _rounded(chain_edges(spark, sf_dir), "conf")


VOTE_SQL = "WITH " + CHAIN_SQL + """, v AS (SELECT src, dst, count(*) AS votes, avg(CASE WHEN type = 'pre' THEN 1.0 ELSE 0.0 END) AS share, avg(greatest(0, least(1, conf))) AS mean_conf FROM good GROUP BY src, dst),
b AS (SELECT *, 0.6 * share + 0.4 * mean_conf AS blend, share * votes > votes // 2 AND mean_conf >= 0.5 AS allow FROM v)"""


@query("edge_votes", VOTE_SQL + "SELECT src, dst, votes, round(share, 6) AS share, round(mean_conf, 6) AS mean_conf, round(blend, 6) AS blend, allow FROM b")
def edge_votes(spark, sf_dir: str) -> DataFrame:
    """Votes of all chains on an edge: share of pre, mean confidence, blend, and a majority decision."""
    v = chain_steps(spark, sf_dir).groupBy("src", "dst").agg(F.count("*").alias("votes"), F.avg(F.when(F.col("type") == "pre", 1.0).otherwise(0.0)).alias("share"), F.avg(T.clip01(F.col("conf"))).alias("mean_conf"))
    v = v.withColumn("blend", 0.6 * F.col("share") + 0.4 * F.col("mean_conf")).withColumn("allow", (F.col("share") * F.col("votes") > F.floor(F.col("votes") / 2)) & (F.col("mean_conf") >= 0.5))
    return _rounded(v, "share", "mean_conf", "blend")


@query("edge_keep", VOTE_SQL + """, r AS (SELECT *, count_if(allow) OVER (PARTITION BY src) AS yes, rank() OVER (PARTITION BY src, allow ORDER BY round(blend, 6) DESC) AS k, row_number() OVER (PARTITION BY src, allow ORDER BY round(blend, 6) DESC, dst) AS n FROM b)
SELECT src, dst, round(blend, 6) AS blend, allow FROM r WHERE (allow AND k <= 2) OR (NOT allow AND n <= 2 - yes)""")
def edge_keep(spark, sf_dir: str) -> DataFrame:
    """Two edges of each source: allowed ones with ties at the cut, filled up with the best refused ones."""
    b = edge_votes(spark, sf_dir)
    w = Window.partitionBy("src", "allow").orderBy(F.col("blend").desc())
    r = b.withColumn("yes", F.count_if("allow").over(Window.partitionBy("src"))).withColumn("k", F.rank().over(w)).withColumn("n", F.row_number().over(Window.partitionBy("src", "allow").orderBy(F.col("blend").desc(), "dst")))
    return r.filter("(allow and k <= 2) or (not allow and n <= 2 - yes)").select("src", "dst", "blend", "allow")


MERGE_SQL = f"""gw AS (SELECT id, unnest(list_filter(string_split(regexp_replace(regexp_replace(lower(coalesce(concept_cluster, '')), '[\\s\\p{{Z}}]+', ' ', 'g'), '^ | $', '', 'g'), ' '), lambda w: w <> '')) AS word FROM sn),
gp AS (SELECT id, ' ' || word || ' ' AS p, unnest([3, 4, 5]) AS n FROM gw),
gr AS (SELECT id, substr(p, i, n) AS g FROM (SELECT id, p, n, unnest(range(1, greatest(1, length(p) - n + 1) + 1)) AS i FROM gp WHERE length(p) >= n)),
gtf AS (SELECT id, g, count(*) AS tf FROM gr GROUP BY ALL),
gidf AS (SELECT g, ln((1 + (SELECT count(*) FROM sn)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM gtf GROUP BY g),
gu AS (SELECT id, g, tf * idf AS x, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY id)) AS norm FROM gtf JOIN gidf USING (g)),
cosine AS (SELECT p.a, p.b, sum(x.x * y.x / x.norm / y.norm) AS sim FROM pairs p JOIN gu x ON x.id = p.a JOIN gu y ON y.id = p.b AND y.g = x.g GROUP BY ALL),
ph AS (SELECT DISTINCT id, phrase FROM (SELECT id, unnest(list_transform(string_split(regexp_replace(lower(coalesce(concept_cluster, '')), '[^\\p{{L}}\\p{{N}}| ]', ' ', 'g'), '|'), lambda x: regexp_replace(regexp_replace(x, '\\s+', ' ', 'g'), '^ | $', '', 'g'))) AS phrase FROM sn) WHERE phrase <> ''),
alike AS (SELECT c.a, c.b FROM cosine c JOIN ph x ON x.id = c.a JOIN ph y ON y.id = c.b AND y.phrase = x.phrase WHERE c.sim >= 0.56 GROUP BY ALL),
link AS (SELECT a AS u, b AS v FROM alike UNION SELECT b, a FROM alike UNION SELECT id, id FROM sn),
reach AS (SELECT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON l.u = r.v),
comp AS (SELECT u AS id, min(v) AS component FROM reach GROUP BY u),
mp AS (SELECT id AS old_id, first_value(id) OVER (PARTITION BY component ORDER BY coalesce(freq, 0) DESC, length(coalesce(concept_cluster, '')) DESC, id) AS new_id, count(*) OVER (PARTITION BY component) AS cluster_size FROM sn JOIN comp USING (id)),
"""


def merge_map(spark, sf_dir: str) -> DataFrame:
    s = subnodes(spark, sf_dir)
    pairs = R.pairs_within(s, "parent", "id")
    sims = S.tfidf_pairs(s, "id", S.char_grams(F.col("concept_cluster")), pairs).filter("sim >= 0.56")
    named = s.select("id", T.phrases(F.col("concept_cluster")).alias("p"))
    alike = sims.join(named.select(F.col("id").alias("a"), F.col("p").alias("pa")), "a").join(named.select(F.col("id").alias("b"), F.col("p").alias("pb")), "b").filter(F.arrays_overlap("pa", "pb"))
    return G.homogeneous_merge(s.select("id", "freq", F.col("concept_cluster").alias("text")), alike.select("a", "b"))


@query("tfidf_pairs", BASE_SQL + MERGE_SQL + "z AS (SELECT 1) SELECT a, b, round(sim, 6) AS sim FROM cosine WHERE sim >= 0.3")
def tfidf_pairs(spark, sf_dir: str) -> DataFrame:
    s = subnodes(spark, sf_dir)
    return _rounded(S.tfidf_pairs(s, "id", S.char_grams(F.col("concept_cluster")), R.pairs_within(s, "parent", "id")).filter("sim >= 0.3"), "sim")


@query("subnode_merge", BASE_SQL + MERGE_SQL + "z AS (SELECT 1) SELECT old_id, new_id, cluster_size FROM mp")
def subnode_merge(spark, sf_dir: str) -> DataFrame:
    """Subnodes of one parent that are alike and share a phrase, merged into their most frequent one."""
    return merge_map(spark, sf_dir)


@query("graph_rewrite", BASE_SQL + MERGE_SQL + "z AS (SELECT 1) SELECT s.new_id AS src, t.new_id AS dst, round(max(conf), 6) AS conf, max(cooccur) AS cooccur, round(min(gap), 6) AS gap FROM pre JOIN mp s ON s.old_id = src JOIN mp t ON t.old_id = dst WHERE s.new_id <> t.new_id GROUP BY s.new_id, t.new_id")
def graph_rewrite(spark, sf_dir: str) -> DataFrame:
    return _rounded(G.rewrite_edges(prerequisites(spark, sf_dir), merge_map(spark, sf_dir)), "conf", "gap")


@query("components", BASE_SQL + "l AS (SELECT src AS u, dst AS v FROM pre UNION SELECT dst, src FROM pre), rc AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM rc r JOIN l ON l.u = r.v) SELECT u AS node, least(u, min(v)) AS component FROM rc GROUP BY u")
def components(spark, sf_dir: str) -> DataFrame:
    return connected_components(prerequisites(spark, sf_dir).select("src", "dst"))


START_SQL = "st AS (SELECT min(src) AS node FROM (SELECT src, row_number() OVER (ORDER BY count(*) DESC, src) AS r FROM pre GROUP BY src) WHERE r = 1),"


def _start(edges: DataFrame) -> DataFrame:
    """The source with most edges."""
    return edges.groupBy("src").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "src").limit(1).select(F.col("src").alias("node"))


@query("bfs_depths", BASE_SQL + START_SQL + "l AS (SELECT src AS u, dst AS v FROM pre UNION SELECT dst, src FROM pre), bf AS (SELECT node, 0 AS depth FROM st UNION SELECT l.v, depth + 1 FROM bf JOIN l ON l.u = bf.node WHERE depth < 3) SELECT node, min(depth)::INT AS depth FROM bf GROUP BY node")
def bfs_depths(spark, sf_dir: str) -> DataFrame:
    edges = materialize(prerequisites(spark, sf_dir).select("src", "dst"), "pre")
    return G.depths(edges, _start(edges), 3)


@query("reverse_distance", BASE_SQL + "en AS (SELECT min(dst) AS node FROM (SELECT dst, row_number() OVER (ORDER BY count(*) DESC, dst) AS r FROM pre GROUP BY dst) WHERE r = 1), bf AS (SELECT node, 0 AS depth FROM en UNION SELECT p.src, depth + 1 FROM bf JOIN pre p ON p.dst = bf.node WHERE depth < 3) SELECT node, min(depth)::INT AS depth FROM bf GROUP BY node")
def reverse_distance(spark, sf_dir: str) -> DataFrame:
    """Steps to the target with most edges in, against their direction."""
    edges = materialize(prerequisites(spark, sf_dir).select("src", "dst"), "pre")
    end = edges.groupBy("dst").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "dst").limit(1).select(F.col("dst").alias("node"))
    return G.depths(edges, end, 3, directed=True, backwards=True)


@query("forward_gain", BASE_SQL + """cov AS (SELECT subnode_id AS node, count(*) AS cover FROM idx GROUP BY subnode_id), nd AS (SELECT src AS node FROM pre UNION SELECT dst FROM pre),
rf AS (SELECT node AS start, node, 0 AS d FROM nd UNION SELECT r.start, p.dst, r.d + 1 FROM rf r JOIN pre p ON p.src = r.node WHERE r.d < 2),
mn AS (SELECT start, node, min(d) AS d FROM rf GROUP BY start, node)
SELECT start AS node, round(sum(1 / (d + 1)::DOUBLE / sqrt(1 + coalesce(cover, 0))), 6) AS gain FROM mn LEFT JOIN cov USING (node) GROUP BY start""")
def forward_gain(spark, sf_dir: str) -> DataFrame:
    cover = seed_index(spark, sf_dir).groupBy(F.col("subnode_id").alias("node")).agg(F.count("*").alias("cover"))
    return _rounded(G.forward_gain(prerequisites(spark, sf_dir), cover, 2), "gain")


@query("adjacency", "WITH " + CHAIN_SQL + "SELECT src, string_agg(dst, ',' ORDER BY round(conf, 9) DESC, cooccur, dst, type) AS neighbours, count(*) AS n FROM chain_edges WHERE type = 'pre' GROUP BY src")
def adjacency(spark, sf_dir: str) -> DataFrame:
    """Neighbours of every source, surest first."""
    e = chain_edges(spark, sf_dir).filter("type = 'pre'")
    ordered = F.array_sort(F.collect_list(F.struct((-F.round("conf", 9)).alias("c"), "cooccur", "dst")))
    return e.groupBy("src").agg(F.array_join(F.transform(ordered, lambda x: x["dst"]), ",").alias("neighbours"), F.count("*").alias("n"))


def beam_sql(length: int, beam: int) -> str:
    """The beam search with its steps written out."""
    sql = "WITH " + CHAIN_SQL + """, e AS (SELECT src, dst, type, conf, cooccur FROM chain_edges WHERE type <> 'main_sem'
  UNION ALL SELECT src, dst, type, conf, cooccur FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(conf, 9) DESC, dst) AS r FROM chain_edges WHERE type = 'main_sem') WHERE r <= 3),
b1 AS (SELECT DISTINCT src AS start, [src] AS chain, 0 AS n, 1.0::DOUBLE AS min_conf, 0.0::DOUBLE AS co, 0 AS pre, 0 AS main, 1 AS rank FROM e)"""
    for i in range(2, length + 1):
        sql += f""", g{i} AS (SELECT b.start, list_append(b.chain, e.dst) AS chain, b.n + 1 AS n, least(b.min_conf, e.conf) AS min_conf, b.co + e.cooccur AS co, b.pre + (e.type = 'pre')::INT AS pre, b.main + (e.type = 'main_sem')::INT AS main
  FROM b{i - 1} b JOIN e ON e.src = b.chain[len(b.chain)] WHERE NOT list_contains(b.chain, e.dst) AND (b.main = 0 OR e.type <> 'main_sem')),
k{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY pre DESC, main DESC, round(min_conf, 9) DESC, round(co / n, 9), array_to_string(chain, '>'), n) AS rank FROM g{i}) WHERE rank <= {beam}),
b{i} AS (SELECT * FROM k{i} UNION ALL SELECT * FROM b{i - 1} WHERE start NOT IN (SELECT start FROM k{i}))"""
    return sql + f" SELECT start, array_to_string(chain, '>') AS chain, round(min_conf, 6) AS min_conf, rank::INT AS rank FROM b{length} WHERE len(chain) >= 2"


@query("beam_chains", beam_sql(4, 4))
def beam_chains(spark, sf_dir: str) -> DataFrame:
    """The four best chains of four subnodes from every source."""
    e = chain_edges(spark, sf_dir)
    got = G.beam_chains(e, e.select(F.col("src").alias("node")).distinct(), 4, 4)
    return got.select("start", F.array_join("chain", ">").alias("chain"), F.round("min_conf", 6).alias("min_conf"), "rank")


@query("chain_dups", "WITH s AS (SELECT synth_id, array_to_string(list_transform(chain_subnodes, lambda x: trim(x)), '>') AS sig, coalesce(list_min(edge_confs), 0) AS floor_conf FROM synth_refill WHERE len(chain_subnodes) >= 2) SELECT sig, synth_id, round(floor_conf, 6) AS floor_conf, n FROM (SELECT *, row_number() OVER (PARTITION BY sig ORDER BY floor_conf DESC, synth_id) AS r, count(*) OVER (PARTITION BY sig) AS n FROM s) WHERE r = 1")
def chain_dups(spark, sf_dir: str) -> DataFrame:
    """One row for each distinct chain: the one with the best least confidence, and how many there are."""
    s = table(spark, sf_dir, "synth_refill").filter(F.size("chain_subnodes") >= 2)
    s = s.select("synth_id", F.array_join(F.transform("chain_subnodes", lambda x: F.trim(x)), ">").alias("sig"), F.coalesce(F.array_min("edge_confs"), F.lit(0.0)).alias("floor_conf"))
    best = s.groupBy("sig").agg(F.min_by(F.struct("synth_id", "floor_conf"), F.struct(-F.col("floor_conf"), F.col("synth_id"))).alias("b"), F.count("*").alias("n"))
    return best.select("sig", "b.synth_id", F.round("b.floor_conf", 6).alias("floor_conf"), "n")


@query("chain_difficulty", "WITH " + INDEX_SQL + """, d AS (SELECT subnode_id, avg(coalesce((try_cast(regexp_extract(lower(s.level), '([1-5])', 1) AS DOUBLE) - 1) / 4, 0.5)) AS d FROM idx LEFT JOIN math_seed s USING (qid) GROUP BY subnode_id)
SELECT synth_id, round(avg(coalesce(d, 0.5)), 6) AS chain_d, count(*) AS nodes FROM (SELECT synth_id, trim(unnest(chain_subnodes)) AS subnode_id FROM synth_refill) LEFT JOIN d USING (subnode_id) WHERE subnode_id <> '' GROUP BY synth_id""")
def chain_difficulty(spark, sf_dir: str) -> DataFrame:
    """Mean difficulty of each chain's subnodes; unknown ones count one half."""
    rows = table(spark, sf_dir, "synth_refill").select("synth_id", F.explode("chain_subnodes").alias("s")).select("synth_id", F.trim("s").alias("subnode_id")).filter("subnode_id <> ''")
    return rows.join(subnode_difficulty(spark, sf_dir), "subnode_id", "left").groupBy("synth_id").agg(F.round(F.avg(F.coalesce("d", F.lit(0.5))), 6).alias("chain_d"), F.count("*").alias("nodes"))


@query("seed_usage_reward", "SELECT synth_id, size::INT AS uses, distinct_seeds::INT AS distinct_seeds, round(0.5 * distinct_seeds / size + 0.5 * (CASE WHEN distinct_seeds = 1 THEN 0 ELSE h / ln(greatest(2, distinct_seeds)) END), 6) AS reward FROM (SELECT synth_id, sum(n) AS size, count(*) AS distinct_seeds, -sum(n / tot * ln(n / tot)) AS h FROM (SELECT synth_id, q, count(*) AS n, sum(count(*)) OVER (PARTITION BY synth_id)::DOUBLE AS tot FROM (SELECT synth_id, unnest(selected_seed_qids) AS q FROM synth_refill) WHERE q IS NOT NULL GROUP BY synth_id, q) GROUP BY synth_id)")
def seed_usage_reward(spark, sf_dir: str) -> DataFrame:
    """Half the share of different seeds and half the normalised entropy of their uses: array functions only."""
    q = F.filter("selected_seed_qids", lambda x: x.isNotNull())
    s = table(spark, sf_dir, "synth_refill").select("synth_id", q.alias("q"), F.array_distinct(q).alias("u")).filter(F.size("q") > 0)
    counts = F.transform("u", lambda x: F.size(F.filter("q", lambda y: y == x)))
    return s.select("synth_id", F.size("q").alias("uses"), F.size("u").alias("distinct_seeds"), F.round(0.5 * F.size("u") / F.size("q") + 0.5 * G.normalised_entropy(counts), 6).alias("reward"))


@query("difficulty_mix", "WITH " + INDEX_SQL + """, d AS (SELECT subnode_id, avg(coalesce((try_cast(regexp_extract(lower(s.level), '([1-5])', 1) AS DOUBLE) - 1) / 4, 0.5)) AS d FROM idx LEFT JOIN math_seed s USING (qid) GROUP BY subnode_id),
p AS (SELECT parent_node_id AS parent, round(avg(coalesce(d, 0.5)), 6) AS d FROM subnodes LEFT JOIN d USING (subnode_id) GROUP BY parent_node_id),
m AS (SELECT parent, unnest(['easy', 'medium', 'hard']) AS difficulty, unnest([1, 2, 3]) AS pr, unnest(CASE WHEN d < 0.5 THEN [0.7, 0.3, 0.0] ELSE [0.4, 0.3, 0.3] END)::DOUBLE AS share FROM p),
f AS (SELECT *, floor(7 * share + 1e-9) AS base FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY round(7 * share - base, 9) DESC, pr DESC) AS k, 7 - sum(base) OVER (PARTITION BY parent) AS left_over FROM f),
a AS (SELECT parent, difficulty, pr, (base + (k <= left_over)::INT)::INT AS n FROM r)
SELECT parent, (row_number() OVER (PARTITION BY parent ORDER BY pr, i))::INT AS slot_id, difficulty FROM (SELECT parent, difficulty, pr, unnest(range(n)) AS i FROM a WHERE n > 0)""")
def difficulty_mix(spark, sf_dir: str) -> DataFrame:
    """Seven slots for each parent by largest remainders of a mix that depends on its mean difficulty."""
    d = subnode_difficulty(spark, sf_dir)
    p = subnodes(spark, sf_dir).join(d.withColumnRenamed("subnode_id", "id"), "id", "left").groupBy("parent").agg(F.round(F.avg(F.coalesce("d", F.lit(0.5))), 6).alias("d"))
    mix = F.array(*[F.struct(F.lit(n).alias("difficulty"), F.lit(i + 1).alias("pr"), F.when(F.col("d") < 0.5, lo).otherwise(hi).alias("share")) for i, (n, lo, hi) in enumerate((("easy", 0.7, 0.4), ("medium", 0.3, 0.3), ("hard", 0.0, 0.3)))])
    m = p.select("parent", F.explode(mix).alias("m")).select("parent", "m.*").withColumn("total", F.lit(7))
    a = R.largest_remainder(m, ["parent"], "total", "share", "pr").filter("allocated > 0")
    slots = a.select("parent", "difficulty", "pr", F.explode(F.sequence(F.lit(1), "allocated")).alias("i"))
    return slots.select("parent", F.row_number().over(Window.partitionBy("parent").orderBy("pr", "i")).alias("slot_id"), "difficulty")


@query("backbone_window", "WITH " + CHAIN_SQL.rsplit(",\nchain_edges", 1)[0] + """, c AS (SELECT synth_id, list_transform(chain_subnodes, lambda x: trim(x)) AS chain, edge_types AS t FROM synth_refill WHERE len(chain_subnodes) = len(edge_types) + 1 AND len(chain_subnodes) >= 3),
w AS (SELECT synth_id, i, array_to_string(chain[i:i + 2], '>') AS span, len(list_filter(t[i:i + 1], lambda x: x = 'pre')) AS pre FROM (SELECT *, unnest(range(1, len(chain) - 1)) AS i FROM c))
SELECT synth_id, span, pre::INT AS pre FROM (SELECT *, row_number() OVER (PARTITION BY synth_id ORDER BY pre DESC, i) AS r FROM w) WHERE r = 1""")
def backbone_window(spark, sf_dir: str) -> DataFrame:
    """The three consecutive subnodes of each chain with most pre edges, the earliest of equals: within the row."""
    s = table(spark, sf_dir, "synth_refill").filter((F.size("chain_subnodes") == F.size("edge_types") + 1) & (F.size("chain_subnodes") >= 3))
    chain = F.transform("chain_subnodes", lambda x: F.trim(x))
    spans = F.transform(F.sequence(F.lit(1), F.size("chain_subnodes") - 2), lambda i: F.struct((-F.size(F.filter(F.slice("edge_types", i, 2), lambda t: t == "pre"))).alias("neg"), i.alias("i"), F.array_join(F.slice("chain", i, 3), ">").alias("span")))
    best = F.array_min(spans)
    return s.withColumn("chain", chain).select("synth_id", best.alias("b")).select("synth_id", "b.span", (-F.col("b.neg")).alias("pre"))
