"""Seed, node and index tables of the concept graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.functions import text as T
from skeinworks.operators import relational as R
from skeinworks.plans.registry import query
from skeinworks.runtime import table

MENTION_SQL = r"""
mentions AS (
  SELECT DISTINCT qid, subject, concept FROM (
    SELECT qid, subject, regexp_replace(regexp_replace(lower(x), '[\s\p{Z}]+', ' ', 'g'), '^ | $', '', 'g') AS concept
    FROM (SELECT qid, subject, unnest(regexp_split_to_array(concepts, '[|;]')) AS x FROM audit_relevance))
  WHERE length(concept) >= 3)
"""
INDEX_SQL = """
idx AS (
  SELECT DISTINCT subnode_id, qid FROM (
    SELECT trim(s) AS subnode_id, q AS qid FROM (SELECT unnest(chain_subnodes) AS s, selected_seed_qids FROM synth_refill), UNNEST(selected_seed_qids) AS u(q))
  WHERE subnode_id IS NOT NULL AND subnode_id <> '' AND qid IS NOT NULL)
"""


def mentions(spark, sf_dir: str) -> DataFrame:
    """qid, subject, concept: concepts of at least three characters, once a qid."""
    rows = table(spark, sf_dir, "audit_relevance").select("qid", "subject", F.explode(F.split("concepts", "[|;]")).alias("x"))
    return rows.select("qid", "subject", T.squeeze(F.lower("x")).alias("concept")).filter(F.length("concept") >= 3).distinct()


def seed_index(spark, sf_dir: str) -> DataFrame:
    """subnode_id, qid: seeds used along chains through a subnode."""
    rows = table(spark, sf_dir, "synth_refill").select(F.explode("chain_subnodes").alias("s"), "selected_seed_qids")
    rows = rows.select(F.trim("s").alias("subnode_id"), F.explode("selected_seed_qids").alias("qid"))
    return rows.filter("subnode_id <> '' and qid is not null").distinct()


def seeds(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "math_seed").select("qid", "subject", "level", T.level_to_y(F.col("level")).alias("y"))


def subnode_difficulty(spark, sf_dir: str) -> DataFrame:
    """subnode_id, d: mean difficulty of a subnode's seeds; seeds of unknown level count as one half."""
    joined = seed_index(spark, sf_dir).join(seeds(spark, sf_dir).select("qid", "y"), "qid", "left")
    return joined.groupBy("subnode_id").agg(F.avg(F.coalesce("y", F.lit(0.5))).alias("d"))


@query(
    "seed_prepare",
    """SELECT qid, source, subject, level, round(coalesce((try_cast(regexp_extract(lower(level), '([1-5])', 1) AS DOUBLE) - 1) / 4, 0.5), 6) AS y,
    CASE WHEN coalesce(try_cast(regexp_extract(level, '([1-5])', 1) AS INT), 3) <= 2 THEN 'easy' WHEN coalesce(try_cast(regexp_extract(level, '([1-5])', 1) AS INT), 3) = 3 THEN 'medium' ELSE 'hard' END AS difficulty,
    'MATH_' || lpad(CAST(row_number() OVER (ORDER BY qid) - 1 AS VARCHAR), 7, '0') AS new_id FROM math_seed""",
)
def seed_prepare(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "math_seed").select("qid", "source", "subject", "level", F.round(T.level_to_y(F.col("level")), 6).alias("y"), T.level_to_difficulty(F.col("level")).alias("difficulty"))
    return R.dense_id(rows, ["qid"], "n").withColumn("new_id", F.format_string("MATH_%07d", "n")).drop("n")


@query("seed_levels", "SELECT lower(trim(source)) AS source, subject, count(*) AS seeds, round(avg((try_cast(regexp_extract(lower(level), '([1-5])', 1) AS DOUBLE) - 1) / 4), 6) AS mean_y, count_if(trim(coalesce(answer, '')) = '')::BIGINT AS unanswered FROM math_seed GROUP BY ALL")
def seed_levels(spark, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "math_seed")
    return s.groupBy(F.lower(F.trim("source")).alias("source"), "subject").agg(F.count("*").alias("seeds"), F.round(F.avg(T.level_to_y(F.col("level"), None)), 6).alias("mean_y"), F.count_if(F.trim(F.coalesce("answer", F.lit(""))) == "").alias("unanswered"))


@query(
    "node_build",
    "WITH " + MENTION_SQL + """, f AS (SELECT concept, count(DISTINCT qid) AS freq FROM mentions GROUP BY concept),
    m AS (SELECT concept, subject FROM (SELECT concept, subject, row_number() OVER (PARTITION BY concept ORDER BY count(*) DESC, subject) AS r FROM mentions WHERE trim(coalesce(subject, '')) NOT IN ('', 'nan') GROUP BY concept, subject) WHERE r = 1)
    SELECT 'N' || lpad(CAST(row_number() OVER (ORDER BY freq DESC, concept) - 1 AS VARCHAR), 7, '0') AS node_id, concept, subject, freq FROM f LEFT JOIN m USING (concept) WHERE freq >= 3""",
)
def node_build(spark, sf_dir: str) -> DataFrame:
    """Concepts of at least three questions, with their most frequent subject, numbered by frequency."""
    m = mentions(spark, sf_dir)
    freq = m.groupBy("concept").agg(F.countDistinct("qid").alias("freq")).filter("freq >= 3")
    out = freq.join(R.mode_first(m, ["concept"], "subject"), "concept", "left").withColumn("neg", -F.col("freq"))
    return R.dense_id(out, ["neg", "concept"], "n").select(F.format_string("N%07d", "n").alias("node_id"), "concept", "subject", "freq")


@query("seed_links", "WITH " + INDEX_SQL + "SELECT i.subnode_id, i.qid, s.level, round(coalesce((try_cast(regexp_extract(lower(s.level), '([1-5])', 1) AS DOUBLE) - 1) / 4, 0.5), 6) AS y FROM idx i LEFT JOIN math_seed s USING (qid) WHERE i.subnode_id IN (SELECT subnode_id FROM subnodes)")
def seed_links(spark, sf_dir: str) -> DataFrame:
    """Index rows of known subnodes with their seed's level."""
    known = table(spark, sf_dir, "subnodes").select("subnode_id")
    joined = seed_index(spark, sf_dir).join(known, "subnode_id", "left_semi").join(table(spark, sf_dir, "math_seed").select("qid", "level"), "qid", "left")
    return joined.select("subnode_id", "qid", "level", F.round(T.level_to_y(F.col("level")), 6).alias("y"))


@query("q2subnodes", "WITH " + INDEX_SQL + "SELECT qid, string_agg(subnode_id, ',' ORDER BY subnode_id) AS subnode_ids, count(*) AS n FROM idx GROUP BY qid")
def q2subnodes(spark, sf_dir: str) -> DataFrame:
    return seed_index(spark, sf_dir).groupBy("qid").agg(F.array_join(F.array_sort(F.collect_set("subnode_id")), ",").alias("subnode_ids"), F.count("*").alias("n"))


@query("topic_table", "SELECT msc_full, domain, count(DISTINCT subnode_id) AS node_count, sum(freq)::BIGINT AS total_freq FROM subnodes GROUP BY msc_full, domain")
def topic_table(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "subnodes").groupBy("msc_full", "domain").agg(F.countDistinct("subnode_id").alias("node_count"), F.sum("freq").alias("total_freq"))


@query(
    "subnode_concepts",
    "WITH " + MENTION_SQL + """, c AS (SELECT subject, concept, count(*) AS freq FROM mentions GROUP BY subject, concept),
    r AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY freq DESC, concept) AS k FROM c)
    SELECT subject, string_agg(concept, ' | ' ORDER BY k) AS concept_cluster, sum(freq)::BIGINT AS freq FROM r WHERE k <= 3 GROUP BY subject""",
)
def subnode_concepts(spark, sf_dir: str) -> DataFrame:
    """The three most frequent concepts of each subject as one label."""
    c = mentions(spark, sf_dir).groupBy("subject", "concept").agg(F.count("*").alias("freq"))
    best = R.top_k(c, ["subject"], [F.col("freq").desc(), F.col("concept")], 3, "k")
    return best.groupBy("subject").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "concept"))), lambda x: x["concept"]), " | ").alias("concept_cluster"), F.sum("freq").alias("freq"))


@query("subnode_difficulty", "WITH " + INDEX_SQL + "SELECT subnode_id, round(avg(coalesce((try_cast(regexp_extract(lower(s.level), '([1-5])', 1) AS DOUBLE) - 1) / 4, 0.5)), 6) AS d FROM idx LEFT JOIN math_seed s USING (qid) GROUP BY subnode_id")
def subnode_difficulty_query(spark, sf_dir: str) -> DataFrame:
    return subnode_difficulty(spark, sf_dir).select("subnode_id", F.round("d", 6).alias("d"))


@query(
    "level_seed_pick",
    "WITH " + INDEX_SQL + "SELECT subnode_id, level, min(qid) AS qid, count(*) AS choices FROM (SELECT subnode_id, qid, try_cast(regexp_extract(s.level, '([1-5])', 1) AS INT) AS level FROM idx JOIN math_seed s USING (qid)) WHERE level IS NOT NULL GROUP BY subnode_id, level",
)
def level_seed_pick(spark, sf_dir: str) -> DataFrame:
    """One seed of each level for every subnode: the least qid."""
    s = table(spark, sf_dir, "math_seed").select("qid", F.regexp_extract("level", "([1-5])", 1).try_cast("int").alias("level")).filter("level is not null")
    return seed_index(spark, sf_dir).join(s, "qid").groupBy("subnode_id", "level").agg(F.min("qid").alias("qid"), F.count("*").alias("choices"))


@query(
    "concept_vote",
    "WITH " + MENTION_SQL + """, v AS (SELECT subject, concept, count(DISTINCT qid) AS votes FROM mentions GROUP BY subject, concept),
    t AS (SELECT subject, count(DISTINCT qid) AS voters FROM mentions GROUP BY subject)
    SELECT subject, concept, votes, voters, round(votes / voters::DOUBLE, 6) AS share FROM v JOIN t USING (subject) WHERE votes * 50 >= voters""",
)
def concept_vote(spark, sf_dir: str) -> DataFrame:
    """Concepts that at least one question in fifty of a subject votes for."""
    m = mentions(spark, sf_dir)
    v = m.groupBy("subject", "concept").agg(F.countDistinct("qid").alias("votes"))
    t = m.groupBy("subject").agg(F.countDistinct("qid").alias("voters"))
    return v.join(t, "subject").filter("votes * 50 >= voters").withColumn("share", F.round(F.col("votes") / F.col("voters"), 6))


@query(
    "concept_profile",
    "WITH " + MENTION_SQL + """, b AS (SELECT DISTINCT qid, trim(bucket) AS code FROM audit_relevance WHERE bucket IS NOT NULL),
    c AS (SELECT code, concept, count(DISTINCT qid) AS n FROM mentions JOIN b USING (qid) GROUP BY code, concept)
    SELECT code, concept, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n DESC, concept) AS rank FROM c) WHERE rank <= 24""",
)
def concept_profile(spark, sf_dir: str) -> DataFrame:
    """The 24 most frequent concepts of each code (here the audit bucket)."""
    b = table(spark, sf_dir, "audit_relevance").filter("bucket is not null").select("qid", F.trim("bucket").alias("code")).distinct()
    c = mentions(spark, sf_dir).join(b, "qid").groupBy("code", "concept").agg(F.countDistinct("qid").alias("n"))
    return R.top_k(c, ["code"], [F.col("n").desc(), F.col("concept")], 24)


CODE_SQL = "WITH " + MENTION_SQL + """,
b AS (SELECT qid, min(trim(bucket)) AS code, min(subject) AS subject FROM audit_relevance WHERE bucket IS NOT NULL AND subject IS NOT NULL GROUP BY qid),
c AS (SELECT code, concept, count(DISTINCT qid) AS n FROM mentions JOIN b USING (qid) GROUP BY code, concept),
top AS (SELECT code, concept FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n DESC, concept) AS r FROM c) WHERE r <= 24),
sc AS (SELECT subject, code, count(*) AS n FROM b GROUP BY subject, code),
st AS (SELECT subject, count(*) AS total FROM b GROUP BY subject),
codes AS (SELECT DISTINCT code FROM b),
k AS (SELECT count(*) AS k FROM codes),
rows AS (SELECT b.qid, b.subject, b.code AS old_code, count(m.concept) AS size FROM b JOIN (SELECT DISTINCT qid, concept FROM mentions) m USING (qid) GROUP BY ALL),
hit AS (SELECT m.qid, t.code, count(*) AS hits FROM (SELECT DISTINCT qid, concept FROM mentions) m JOIN top t USING (concept) GROUP BY ALL),
s AS (SELECT r.qid, r.old_code, cs.code, 0.8 * coalesce(h.hits, 0) / r.size + 0.2 * (coalesce(sc.n, 0) + 1) / (st.total + k.k)::DOUBLE AS score
  FROM rows r CROSS JOIN codes cs CROSS JOIN k JOIN st ON st.subject = r.subject LEFT JOIN sc ON sc.subject = r.subject AND sc.code = cs.code LEFT JOIN hit h ON h.qid = r.qid AND h.code = cs.code)
"""


@query("code_repair", CODE_SQL + """SELECT b.qid, b.old_code, b.code AS new_code, round(b.score, 6) AS new_score, round(o.score, 6) AS old_score
FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, code) AS r FROM s) b JOIN s o ON o.qid = b.qid AND o.code = b.old_code
WHERE r = 1 AND b.code <> b.old_code AND b.score - o.score >= 0.05""")  # fmt: skip
def code_repair(spark, sf_dir: str) -> DataFrame:
    """Rows whose concepts fit another code better: 0.8 overlap with the code's profile + 0.2 smoothed prior of the subject."""
    rows = table(spark, sf_dir, "audit_relevance").filter("bucket is not null and subject is not null").groupBy("qid").agg(F.min(F.trim("bucket")).alias("old_code"), F.min("subject").alias("subject"))
    m = mentions(spark, sf_dir).select("qid", "concept").distinct()
    profile = R.top_k(m.join(rows, "qid").groupBy(F.col("old_code").alias("code"), "concept").agg(F.countDistinct("qid").alias("n")), ["code"], [F.col("n").desc(), F.col("concept")], 24).select("code", "concept")
    counts = rows.groupBy("subject", F.col("old_code").alias("code")).agg(F.count("*").alias("n"))
    kinds = profile.select("code").distinct().agg(F.count("*").alias("k"))  # one row
    totals = rows.groupBy("subject").agg(F.count("*").alias("total"))
    sized = rows.join(m.groupBy("qid").agg(F.count("*").alias("size")), "qid").join(totals, "subject")
    hits = m.join(profile, "concept").groupBy("qid", "code").agg(F.count("*").alias("hits"))
    # No other code can be best: one without a hit scores by its prior alone, and the subject's commonest has the best of those.
    common = counts.groupBy("subject").agg(F.min_by("code", F.struct(-F.col("n"), F.col("code"))).alias("code"))
    tried = hits.select("qid", "code").unionByName(rows.join(common, "subject").select("qid", "code")).unionByName(rows.select("qid", F.col("old_code").alias("code"))).distinct()
    every = sized.join(tried, "qid").join(F.broadcast(kinds), how="cross")
    scored = every.join(counts, ["subject", "code"], "left").join(hits, ["qid", "code"], "left")
    scored = scored.withColumn("score", 0.8 * F.coalesce("hits", F.lit(0)) / F.col("size") + 0.2 * (F.coalesce("n", F.lit(0)) + 1) / (F.col("total") + F.col("k")).cast("double"))
    best = scored.groupBy("qid", "old_code").agg(F.min_by(F.struct("code", "score"), F.struct(-F.round("score", 9), F.col("code"))).alias("best"), F.max(F.when(F.col("code") == F.col("old_code"), F.col("score"))).alias("old"))
    out = best.filter("best.code <> old_code and best.score - old >= 0.05")
    return out.select("qid", "old_code", F.col("best.code").alias("new_code"), F.round("best.score", 6).alias("new_score"), F.round("old", 6).alias("old_score"))
