"""Codes of subjects: candidates from shared concepts, allowed areas, evidence, auxiliary codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.functions import codes as C
from skeinworks.functions import text as T
from skeinworks.operators import relational as R
from skeinworks.plans.registry import query
from skeinworks.plans.seeds import MENTION_SQL, mentions
from skeinworks.runtime import table

AREA_TOP, GLOBAL_TOP, MOST = 3, 5, 6
AUX_RATIO, AUX_LEAST, AUX_TOP = 0.5, 1, 2
# Codes that need evidence in the text: their prefix, the evidence, and the prefixes preferred instead, in order.
GATES = (("11", r"\b(integer|integers|natural number|lattice point|remainder)\b", ("15", "26")), ("60", r"\b(probability|random|chance|expected)\b", ("05", "51")))

_PHRASE = "regexp_replace(regexp_replace(lower(x), '[\\s\\p{Z}]+', ' ', 'g'), '^ | $', '', 'g')"
CAND_SQL = "WITH " + MENTION_SQL + f""",
full_codes AS (SELECT subnode_id, msc_full AS code, domain, concept_cluster FROM subnodes WHERE regexp_full_match(coalesce(msc_full, ''), '{C.FULL}')),
ph AS (SELECT DISTINCT code, {_PHRASE} AS concept FROM (SELECT code, unnest(string_split(concept_cluster, '|')) AS x FROM full_codes)),
cand AS (SELECT qid, subject, code, count(*) AS score FROM mentions JOIN ph USING (concept) GROUP BY ALL),
rules AS (SELECT DISTINCT domain AS subject, left(code, 2) AS area FROM full_codes WHERE domain IS NOT NULL),
areas AS (SELECT subject, area AS own FROM (SELECT domain AS subject, left(code, 2) AS area, row_number() OVER (PARTITION BY domain ORDER BY count(*) DESC, left(code, 2)) AS r FROM full_codes WHERE domain IS NOT NULL GROUP BY domain, left(code, 2)) WHERE r = 1),
j AS (SELECT cand.*, coalesce(own, '00') AS own, rules.area IS NOT NULL OR NOT EXISTS (SELECT 1 FROM rules q WHERE q.subject = cand.subject) AS allowed
  FROM cand LEFT JOIN areas ON areas.subject = cand.subject LEFT JOIN rules ON rules.subject = cand.subject AND rules.area = left(code, 2)),
fin AS (SELECT qid, subject, min_by(code, o) AS initial, coalesce(min_by(code, o) FILTER (WHERE allowed AND o = 1), min_by(code, o) FILTER (WHERE allowed), min_by(code, o) FILTER (WHERE left(code, 2) = own), min_by(code, o)) AS final
  FROM (SELECT *, row_number() OVER (PARTITION BY qid, subject ORDER BY score DESC, code) AS o FROM j) GROUP BY qid, subject)
"""


def full_codes(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "subnodes").filter(F.coalesce("msc_full", F.lit("")).rlike(f"^{C.FULL}$")).select("subnode_id", F.col("msc_full").alias("code"), "domain", "concept_cluster")


def allowed_areas(codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """subject, area of the areas that a subject may use, and subject, own: the area it uses most."""
    rows = codes.filter("domain is not null").select(F.col("domain").alias("subject"), F.substring("code", 1, 2).alias("area"))
    n = rows.groupBy("subject", "area").agg(F.count("*").alias("n"))
    return rows.distinct(), n.groupBy("subject").agg(F.min_by("area", F.struct(-F.col("n"), F.col("area"))).alias("own"))


def candidates(spark, sf_dir: str) -> DataFrame:
    """qid, subject, code, score (shared concepts), own, allowed: codes whose concepts a question shares.

    Rules are per subject; a subject without any allows every code. They are joined to candidates only, so no row meets all codes.
    """
    codes = full_codes(spark, sf_dir)
    ph = codes.select("code", F.explode(F.split("concept_cluster", r"\|")).alias("x")).select("code", T.squeeze(F.lower("x")).alias("concept")).distinct()
    cand = mentions(spark, sf_dir).join(ph, "concept").groupBy("qid", "subject", "code").agg(F.count("*").alias("score"))
    rules, areas = allowed_areas(codes)
    some = rules.select("subject").distinct().withColumn("ruled", F.lit(True))
    named = cand.withColumn("area", F.substring("code", 1, 2))
    out = named.join(areas, "subject", "left").join(some, "subject", "left").join(rules.withColumn("listed", F.lit(True)), ["subject", "area"], "left")
    allowed = F.col("listed").isNotNull() | F.col("ruled").isNull()
    return out.select("qid", "subject", "code", "score", F.coalesce("own", F.lit("00")).alias("own"), allowed.alias("allowed"))


def final_codes(cand: DataFrame) -> DataFrame:
    """qid, subject, initial, final: the best candidate, or the best allowed one, the best of the subject's own area, any."""
    order = F.struct(-F.col("score"), F.col("code"))
    best = lambda c: F.min_by(F.when(c, F.col("code")), F.when(c, order))
    got = cand.groupBy("qid", "subject").agg(best(F.lit(True)).alias("initial"), best(F.col("allowed")).alias("a"), best(F.substring("code", 1, 2) == F.col("own")).alias("o"))
    return got.select("qid", "subject", "initial", F.coalesce("a", "o", "initial").alias("final"))


def gated(rows: DataFrame, cand: DataFrame, gates=GATES) -> DataFrame:
    """rows (qid, subject, final, text) with new_code and reason: codes without their evidence give way to another candidate.

    The replacement is the first legal candidate by preferred prefix, then score, then code; without one the code stays.
    """
    need = F.lit(None).cast("int")
    for k, (prefix, evidence, _) in reversed(list(enumerate(gates))):
        need = F.when(F.col("final").startswith(prefix) & ~F.col("text").rlike(evidence), k).otherwise(need)
    rows = rows.withColumn("gate", need)
    choice = cand.join(rows.filter("gate is not null").select("qid", "subject", "gate"), ["qid", "subject"])
    rank, legal = F.lit(99), F.lit(False)
    for k, (prefix, _, preferred) in enumerate(gates):
        own = F.col("gate") == k
        legal = F.when(own, ~F.col("code").startswith(prefix)).otherwise(legal)
        for n, p in reversed(list(enumerate(preferred))):
            rank = F.when(own & F.col("code").startswith(p), n).otherwise(rank)
    best = choice.filter(legal).groupBy("qid", "subject").agg(F.min_by("code", F.struct(rank, -F.col("score"), F.col("code"))).alias("other"))
    out = rows.join(best, ["qid", "subject"], "left")
    return out.select("qid", "subject", "final", F.coalesce("other", "final").alias("new_code"), F.when(F.col("other").isNotNull(), F.concat(F.lit("needs_evidence_"), F.col("gate").cast("string"))).otherwise("").alias("reason"))


@query("code_lists", rf"""WITH s AS (SELECT parent_node_id AS parent, string_agg(DISTINCT lower(msc_full), '; ' ORDER BY lower(msc_full)) AS value, min_by(msc_full, (-freq, subnode_id)) AS fb FROM subnodes WHERE parent_node_id IS NOT NULL AND msc_full IS NOT NULL GROUP BY parent_node_id),
f AS (SELECT parent, regexp_extract_all(upper(value), '{C.FULL}') AS found, upper(trim(fb)) AS fb FROM s)
SELECT parent, array_to_string(CASE WHEN regexp_full_match(fb, '{C.FULL}') AND NOT list_contains(found, fb) THEN list_concat([fb], found) ELSE found END, ',') AS codes, CASE WHEN left(fb, 2) IN ('11', '12', '20') THEN 'number_theory' WHEN left(fb, 2) IN ('05', '60', '62', '68') THEN 'combinatorics' WHEN left(fb, 2) IN ('26', '30', '34', '35') THEN 'calculus' WHEN left(fb, 2) IN ('51', '52', '53', '54', '55', '57', '58') THEN 'geometry' ELSE 'algebra' END AS domain, left(lpad(fb, 2, '0'), 2) || 'A05' AS default_code FROM f""".replace("min_by(msc_full, (-freq, subnode_id))", "(array_agg(msc_full ORDER BY freq DESC, subnode_id))[1]"))
def code_lists(spark, sf_dir: str) -> DataFrame:
    """The codes of each parent, read from a text, with its most frequent one as fallback, and the defaults of that area."""
    s = table(spark, sf_dir, "subnodes").filter("parent_node_id is not null and msc_full is not null")
    g = s.groupBy(F.col("parent_node_id").alias("parent")).agg(F.array_join(F.array_sort(F.collect_set(F.lower("msc_full"))), "; ").alias("value"), F.min_by("msc_full", F.struct(-F.col("freq"), F.col("subnode_id"))).alias("fb"))
    area = F.substring(F.upper(F.trim("fb")), 1, 2)
    return g.select("parent", F.array_join(C.code_list(F.col("value"), F.col("fb")), ",").alias("codes"), C.default_domain(area).alias("domain"), C.default_code(area).alias("default_code"))


@query("code_membership", rf"SELECT subnode_id, CASE WHEN c IN (SELECT regexp_extract(msc_full, '({C.FULL})', 1) FROM subnodes WHERE domain IS NOT NULL AND msc_full IS NOT NULL) THEN c ELSE '' END AS code FROM (SELECT subnode_id, regexp_extract(coalesce(msc_full, ''), '({C.FULL})', 1) AS c FROM subnodes)")
def code_membership(spark, sf_dir: str) -> DataFrame:
    """The first code of each text, if it is one of those that rows with a domain have."""
    s = table(spark, sf_dir, "subnodes").select("subnode_id", "domain", T.subject_code(F.col("msc_full")).alias("c"))
    legal = s.filter("domain is not null").select("c").distinct().withColumn("legal", F.lit(True))
    return s.join(legal, "c", "left").select("subnode_id", F.when(F.col("legal"), F.col("c")).otherwise("").alias("code"))


@query("code_candidates", CAND_SQL + f""", r AS (SELECT *, row_number() OVER (PARTITION BY qid, subject ORDER BY score DESC, code) AS g, CASE WHEN left(code, 2) = own THEN row_number() OVER (PARTITION BY qid, subject, left(code, 2) = own ORDER BY score DESC, code) END AS a FROM j),
m AS (SELECT qid, code, score, row_number() OVER (PARTITION BY qid, subject ORDER BY CASE WHEN a <= {AREA_TOP} THEN 0 ELSE 1 END, score DESC, code) AS place FROM r WHERE a <= {AREA_TOP} OR g <= {GLOBAL_TOP})
SELECT qid, code, score, place::INT AS place FROM m WHERE place <= {MOST}""")
def code_candidates(spark, sf_dir: str) -> DataFrame:
    """Each question's candidates: the best of the subject's own area, then the best of all, each once."""
    w = Window.partitionBy("qid", "subject")
    order = [F.col("score").desc(), F.col("code")]
    inside = F.substring("code", 1, 2) == F.col("own")
    c = candidates(spark, sf_dir).withColumn("inside", inside)
    c = c.withColumn("g", F.row_number().over(w.orderBy(*order))).withColumn("a", F.when(F.col("inside"), F.row_number().over(Window.partitionBy("qid", "subject", "inside").orderBy(*order))))
    near = F.coalesce(F.col("a") <= AREA_TOP, F.lit(False))
    m = c.filter(near | (F.col("g") <= GLOBAL_TOP)).withColumn("place", F.row_number().over(w.orderBy((~near).cast("int"), *order)))
    return m.filter(F.col("place") <= MOST).select("qid", "code", "score", "place")


@query("final_codes", CAND_SQL + "SELECT qid, subject, initial, final FROM fin")
def final_codes_query(spark, sf_dir: str) -> DataFrame:
    """Codes repaired to the areas that a subject allows."""
    return final_codes(candidates(spark, sf_dir))


AUX_SQL = CAND_SQL + f""", b AS (SELECT cand.*, final, max(CASE WHEN code = final THEN score END) OVER (PARTITION BY cand.qid, cand.subject) AS base FROM cand JOIN fin ON fin.qid = cand.qid AND fin.subject IS NOT DISTINCT FROM cand.subject),
aux AS (SELECT qid, subject, final, code, score, row_number() OVER (PARTITION BY qid, subject ORDER BY score DESC, code) AS rank FROM b WHERE code <> final AND left(code, 2) = left(final, 2) AND score >= greatest({AUX_LEAST}, {AUX_RATIO} * base))
"""


def auxiliary(cand: DataFrame, final: DataFrame, policy: str = "same_area", ratio: float = AUX_RATIO, least: float = AUX_LEAST, k: int = AUX_TOP) -> DataFrame:
    """qid, subject, final, code, score, rank: other candidates near the final one in score. policy: none, same_area, same_prefix or free."""
    c = cand.select("qid", "subject", "code", "score").join(final.select("qid", "subject", "final"), ["qid", "subject"])
    c = c.withColumn("base", F.max(F.when(F.col("code") == F.col("final"), F.col("score"))).over(Window.partitionBy("qid", "subject")))
    digits = {"none": 0, "same_area": 2, "same_prefix": 3, "free": -1}[policy]
    near = F.lit(False) if digits == 0 else F.lit(True) if digits < 0 else F.substring("code", 1, digits) == F.substring("final", 1, digits)
    ok = c.filter((F.col("code") != F.col("final")) & near & (F.col("score") >= F.greatest(F.lit(float(least)), ratio * F.col("base"))))
    return R.top_k(ok, ["qid", "subject"], [F.col("score").desc(), F.col("code")], k).drop("base")


@query("aux_codes", AUX_SQL + f"SELECT qid, final, code, score, rank::INT AS rank FROM aux WHERE rank <= {AUX_TOP} AND subject IS NOT NULL")
def aux_codes(spark, sf_dir: str) -> DataFrame:
    """Other codes of a question's area that score at least half as much."""
    c = candidates(spark, sf_dir)
    return auxiliary(c, final_codes(c)).select("qid", "final", "code", "score", "rank")


@query("aux_vote", AUX_SQL + """, v AS (SELECT fin.subject, coalesce(a.code, '') AS code, count(*) AS n FROM fin LEFT JOIN (SELECT * FROM aux WHERE rank = 1) a ON a.qid = fin.qid AND a.subject = fin.subject WHERE fin.subject IS NOT NULL GROUP BY ALL),
t AS (SELECT *, sum(n) OVER (PARTITION BY subject) AS votes, row_number() OVER (PARTITION BY subject ORDER BY n DESC, code) AS r FROM v)
SELECT subject, CASE WHEN n >= votes // 2 + 1 THEN code ELSE '' END AS code, n, votes::BIGINT AS votes FROM t WHERE r = 1""")
def aux_vote(spark, sf_dir: str) -> DataFrame:
    """Each subject's most frequent auxiliary code if a majority has it; a question without one votes blank."""
    c = candidates(spark, sf_dir).filter("subject is not null")
    final = final_codes(c)
    first = auxiliary(c, final, k=1).select("qid", "subject", "code")
    n = final.join(first, ["qid", "subject"], "left").groupBy("subject", F.coalesce("code", F.lit("")).alias("code")).agg(F.count("*").alias("n"))
    best = n.groupBy("subject").agg(F.min_by(F.struct("code", "n"), F.struct(-F.col("n"), F.col("code"))).alias("b"), F.sum("n").alias("votes"))
    return best.select("subject", F.when(F.col("b.n") >= F.floor(F.col("votes") / 2) + 1, F.col("b.code")).otherwise("").alias("code"), F.col("b.n").alias("n"), "votes")


def _gate_sql() -> str:
    need = "CASE " + " ".join(f"WHEN starts_with(final, '{p}') AND NOT regexp_matches(txt, '{e}') THEN {k}" for k, (p, e, _) in enumerate(GATES)) + " END"
    rank = "CASE " + " ".join(f"WHEN gate = {k} AND starts_with(code, '{x}') THEN {n}" for k, (_, _, ps) in enumerate(GATES) for n, x in enumerate(ps)) + " ELSE 99 END"
    legal = " OR ".join(f"gate = {k} AND NOT starts_with(code, '{p}')" for k, (p, _, _) in enumerate(GATES))
    return f""", x AS (SELECT qid, subject, min(lower(coalesce(problem, ''))) AS txt FROM audit_relevance GROUP BY qid, subject),
y AS (SELECT fin.qid, fin.subject, final, {need} AS gate FROM fin JOIN x ON x.qid = fin.qid AND x.subject = fin.subject),
z AS (SELECT y.qid, y.subject, code, row_number() OVER (PARTITION BY y.qid, y.subject ORDER BY {rank}, score DESC, code) AS r FROM y JOIN cand ON cand.qid = y.qid AND cand.subject = y.subject WHERE {legal})
SELECT y.qid, final, coalesce(code, final) AS new_code, CASE WHEN code IS NOT NULL THEN 'needs_evidence_' || gate ELSE '' END AS reason FROM y LEFT JOIN z ON z.qid = y.qid AND z.subject = y.subject AND r = 1"""


@query("code_gate", CAND_SQL + _gate_sql())
def code_gate(spark, sf_dir: str) -> DataFrame:
    """Codes that need evidence in the problem's text and lack it, replaced by another candidate."""
    c = candidates(spark, sf_dir).filter("subject is not null")
    text = table(spark, sf_dir, "audit_relevance").groupBy("qid", "subject").agg(F.min(F.lower(F.coalesce("problem", F.lit("")))).alias("text"))
    return gated(final_codes(c).join(text, ["qid", "subject"]), c).select("qid", "final", "new_code", "reason")


@query("default_subnodes", CAND_SQL + f""", d AS (SELECT code, subnode_id AS main FROM (SELECT s.subnode_id, s.msc_full AS code, row_number() OVER (PARTITION BY s.msc_full ORDER BY freq DESC, s.subnode_id) AS r FROM subnodes s JOIN full_codes USING (subnode_id)) WHERE r = 1),
o AS (SELECT code, {_PHRASE} AS concept, min(subnode_id) AS own FROM (SELECT code, subnode_id, unnest(string_split(concept_cluster, '|')) AS x FROM full_codes) GROUP BY ALL)
SELECT coalesce(own, main) AS subnode_id, count(*) AS mentions, count(own) AS by_concept FROM fin JOIN mentions m ON m.qid = fin.qid AND m.subject IS NOT DISTINCT FROM fin.subject JOIN d ON d.code = fin.final LEFT JOIN o ON o.code = fin.final AND o.concept = m.concept WHERE fin.subject IS NOT NULL GROUP BY 1""")
def default_subnodes(spark, sf_dir: str) -> DataFrame:
    """Mentions by the subnode that takes them: the code's subnode with that concept, else its most frequent one."""
    codes = full_codes(spark, sf_dir)
    freq = table(spark, sf_dir, "subnodes").select("subnode_id", "freq")
    main = codes.join(freq, "subnode_id").groupBy("code").agg(F.min_by("subnode_id", F.struct(-F.col("freq"), F.col("subnode_id"))).alias("main"))
    own = codes.select("code", "subnode_id", F.explode(F.split("concept_cluster", r"\|")).alias("x")).groupBy("code", T.squeeze(F.lower("x")).alias("concept")).agg(F.min("subnode_id").alias("own"))
    c = candidates(spark, sf_dir).filter("subject is not null")
    rows = final_codes(c).join(mentions(spark, sf_dir), ["qid", "subject"]).withColumnRenamed("final", "code").join(main, "code").join(own, ["code", "concept"], "left")
    return rows.groupBy(F.coalesce("own", "main").alias("subnode_id")).agg(F.count("*").alias("mentions"), F.count("own").alias("by_concept"))


@query("outline_catalogue", rf"""WITH c AS (SELECT msc_full AS code, trim(concept_cluster) AS d, domain FROM subnodes WHERE regexp_full_match(coalesce(msc_full, ''), '{C.FULL}') AND regexp_matches(coalesce(concept_cluster, ''), '^[a-z]'))
SELECT code, left(code, 2) AS l1, left(code, 3) || 'xx' AS l2, min(d) AS desc, coalesce(any_value(a.x), '') AS l1_desc, coalesce(any_value(b.x), '') AS l2_desc FROM c
LEFT JOIN (SELECT left(code, 2) AS k, min(domain) AS x FROM c WHERE domain IS NOT NULL GROUP BY 1) a ON a.k = left(code, 2) LEFT JOIN (SELECT left(code, 3) AS k, max(domain) AS x FROM c WHERE domain IS NOT NULL GROUP BY 1) b ON b.k = left(code, 3) GROUP BY code""")
def outline_catalogue_query(spark, sf_dir: str) -> DataFrame:
    """An outline's lines on three levels, written from the subnodes, read back as a catalogue."""
    from skeinworks.sources.files import outline_catalogue

    c = full_codes(spark, sf_dir).filter(F.coalesce("concept_cluster", F.lit("")).rlike("^[a-z]"))
    named = c.filter("domain is not null")
    heads = lambda n, end, pick: named.groupBy(F.substring("code", 1, n).alias("k")).agg(pick("domain").alias("x")).select(F.concat("k", F.lit(end), F.lit("  "), "x").alias("value"))
    lines = heads(2, "-XX", F.min).unionByName(heads(3, "xx", F.max)).unionByName(c.select(F.concat(F.lit("  "), "code", F.lit(" "), "concept_cluster", F.lit(" ")).alias("value")))
    return outline_catalogue(lines.unionByName(spark.createDataFrame([("",), ("no code here",)], "value string")))
