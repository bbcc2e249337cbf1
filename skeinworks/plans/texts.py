"""Text columns, validators and retrieval over the document and problem tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.functions import text as T
from skeinworks.functions import validate as V
from skeinworks.operators import relational as R
from skeinworks.operators import similarity as S
from skeinworks.plans.registry import query
from skeinworks.runtime import table

SP = r"[\s\p{Z}\x0b\x{85}\x{1c}-\x{1f}]"


def norm_sql(c: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '{SP}+', ' ', 'g'), '^ | $', '', 'g'), '[`*_]', '', 'g')"


@query("text_normalize", f"SELECT doc_id, {norm_sql('text')} AS norm, length({norm_sql('text')}) AS n FROM documents")
def text_normalize(spark, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("norm"))
    return d.withColumn("n", F.length("norm").cast("long"))


@query("token_stats", f"SELECT token, count(DISTINCT doc_id) AS df, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all({norm_sql('text')}, '[a-z0-9]+')) AS token FROM documents) GROUP BY token")
def token_stats(spark, sf_dir: str) -> DataFrame:
    """Document and collection frequency of every token.

    A row's tokens are sorted and the first of each run marked, so one shuffle of partial sums gives both.
    """
    d = table(spark, sf_dir, "documents").select(F.array_sort(T.tokens(F.col("text"))).alias("t"))
    marked = F.transform("t", lambda x, i: F.struct(x.alias("token"), F.when((i == 0) | (F.get("t", i - 1) != x), 1).otherwise(0).alias("first")))
    return d.select(F.explode(marked).alias("m")).groupBy("m.token").agg(F.sum("m.first").alias("df"), F.count("*").alias("tf"))


@query("doc_lengths", f"SELECT source, count(*) AS docs, round(avg(n), 6) AS mean_tokens, max(n) AS max_tokens FROM (SELECT lower(trim(source)) AS source, len(regexp_extract_all({norm_sql('text')}, '[a-z0-9]+')) AS n FROM documents) GROUP BY source")
def doc_lengths(spark, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.lower(F.trim("source")).alias("source"), F.size(T.tokens(F.col("text"))).cast("long").alias("n"))
    return d.groupBy("source").agg(F.count("*").alias("docs"), F.round(F.avg("n"), 6).alias("mean_tokens"), F.max("n").alias("max_tokens"))


@query("boxed_answers", rf"SELECT DISTINCT answer_id, coalesce(regexp_replace(regexp_extract_all(final_answer, '\\boxed\{{([^{{}}]+)\}}', 1)[-1], '^{SP}+|{SP}+$', '', 'g'), '') AS answer FROM answered_rows")
def boxed_answers(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "answered_rows").select("answer_id", T.boxed_answer(F.col("final_answer")).alias("answer")).distinct()


@query("relation_counts", r"SELECT row_id, (len(regexp_extract_all(p, '\\le')) + len(regexp_extract_all(p, '\\ge')) + len(regexp_extract_all(p, '≤')) + len(regexp_extract_all(p, '≥')) + len(regexp_extract_all(p, '\\equiv')) + len(regexp_extract_all(p, '\\mid')) + len(regexp_extract_all(p, '=')) + len(regexp_extract_all(p, '<')) + len(regexp_extract_all(p, '>')))::INT AS relations FROM (SELECT row_id, coalesce(problem, '') AS p FROM math_train)")
def relation_counts(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "math_train").select("row_id", T.relation_count(F.col("problem")).alias("relations"))


_PATTERN = rf"(?is)^(.*)\b({T.QUERY_VERBS})\b"
_BODY = norm_sql(rf"CASE WHEN regexp_matches(coalesce(problem, ''), '{_PATTERN}') THEN regexp_extract(problem, '{_PATTERN}', 1) ELSE problem END")
SKELETON_SQL = rf"trim(regexp_replace(regexp_replace(regexp_replace({_BODY}, '\b[0-9]+\b', 'N', 'g'), '\b[a-z][0-9]*\b', 'v', 'g'), ' +', ' ', 'g'))"


@query("skeleton_dups", f"SELECT skeleton, count(*) AS n, min(synth_id) AS first_id FROM (SELECT synth_id, {SKELETON_SQL} AS skeleton FROM synth_refill) WHERE len(string_split(skeleton, ' ')) >= 8 GROUP BY skeleton HAVING count(*) > 1")
def skeleton_dups(spark, sf_dir: str) -> DataFrame:
    """Problem bodies of at least eight words that agree once numbers and letters are masked."""
    s = table(spark, sf_dir, "synth_refill").select("synth_id", T.body_skeleton(F.col("problem")).alias("skeleton"))
    s = s.filter(F.size(F.split("skeleton", " ")) >= 8)
    return s.groupBy("skeleton").agg(F.count("*").alias("n"), F.min("synth_id").alias("first_id")).filter("n > 1")


@query("surface_ok", V.SURFACE_SQL)
def surface_ok(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "math_train").select("row_id", V.surface_error(F.col("problem")).alias("reason"))


@query("free_symbols", rf"""SELECT row_id, array_to_string(list_sort(d), ',') AS declared, array_to_string(list_sort(a), ',') AS assigned, len(list_filter(d, lambda x: NOT list_contains(a, x)))::INT AS unresolved FROM (
  SELECT row_id, list_distinct(list_filter(list_transform(flatten(list_transform(list_concat(regexp_extract_all(p, '{T.DECLARED[0]}', 1), regexp_extract_all(p, '{T.DECLARED[1]}', 1)), lambda x: string_split(x, ','))), lambda x: trim(x)), lambda x: x <> '')) AS d,
  list_distinct(regexp_extract_all(p, '{T.ASSIGNED}', 1)) AS a FROM (SELECT row_id, coalesce(problem, '') AS p FROM math_train))""")
def free_symbols(spark, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "math_train").select("row_id", T.declared_symbols(F.col("problem")).alias("d"), T.assigned_symbols(F.col("problem")).alias("a"))
    return m.select("row_id", F.array_join(F.array_sort("d"), ",").alias("declared"), F.array_join(F.array_sort("a"), ",").alias("assigned"), F.size(F.array_except("d", "a")).alias("unresolved"))


@query("bm25_topk", f"""
WITH d AS (SELECT doc_id, regexp_extract_all({norm_sql('text')}, '[a-z0-9]+') AS t FROM documents),
n AS (SELECT count(*) AS n, greatest(1.0, sum(len(t)) / count(*)) AS avgdl FROM d),
tf AS (SELECT doc_id, len(t) AS dl, term, count(*) AS tf FROM (SELECT doc_id, t, unnest(t) AS term FROM d) GROUP BY ALL),
idf AS (SELECT term, ln(1 + (any_value(n.n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, n GROUP BY term),
q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest(regexp_extract_all({norm_sql('text')}, '[a-z0-9]+')) AS term FROM eval_items) GROUP BY ALL),
s AS (SELECT item_id, doc_id, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM q JOIN tf USING (term) JOIN idf USING (term), n GROUP BY ALL)
SELECT item_id, doc_id, round(score, 6) AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s) WHERE rank <= 5""")
def bm25_topk(spark, sf_dir: str) -> DataFrame:
    """The five documents that answer best to each held-out item."""
    best = S.bm25_top(table(spark, sf_dir, "documents"), "doc_id", T.tokens(F.col("text")), table(spark, sf_dir, "eval_items"), "item_id", T.tokens(F.col("text")), 5)
    return best.select("item_id", "doc_id", F.round("score", 6).alias("score"), "rank")


def seed_tokens_sql(c: str) -> str:
    stop = ",".join(f"'{w}'" for w in T.SEED_STOP)
    return rf"list_distinct(list_filter(string_split(regexp_replace({norm_sql(c)}, '[^a-z0-9\\s]', ' ', 'g'), ' '), lambda w: length(w) >= 2 AND w NOT IN ({stop})))"


COPY_SQL = f"""
WITH d AS (SELECT doc_id, {seed_tokens_sql('text')} AS t, list_distinct(regexp_extract_all(coalesce(text, ''), '[0-9]+')) AS n FROM documents),
i AS (SELECT item_id, {seed_tokens_sql('text')} AS t, list_distinct(regexp_extract_all(coalesce(text, ''), '[0-9]+')) AS n FROM eval_items),
k AS (SELECT doc_id, item_id, count(*) AS shared FROM (SELECT doc_id, unnest(t) AS w FROM d) JOIN (SELECT item_id, unnest(t) AS w FROM i) USING (w) GROUP BY ALL),
m AS (SELECT doc_id, item_id, count(*) AS same FROM (SELECT doc_id, unnest(n) AS w FROM d) JOIN (SELECT item_id, unnest(n) AS w FROM i) USING (w) GROUP BY ALL),
s AS (SELECT k.doc_id, k.item_id, 0.75 * shared / (len(d.t) + len(i.t) - shared) + 0.25 * coalesce(same / nullif(len(d.n) + len(i.n) - coalesce(same, 0), 0)::DOUBLE, 0) AS score
  FROM k JOIN d USING (doc_id) JOIN i USING (item_id) LEFT JOIN m ON m.doc_id = k.doc_id AND m.item_id = k.item_id)
"""


@query("copy_score", COPY_SQL + "SELECT doc_id, item_id, round(score, 6) AS score FROM s WHERE score >= 0.2")
def copy_score(spark, sf_dir: str) -> DataFrame:
    """Documents near to held-out items in words and numbers."""
    got = S.copy_scores(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text", 0.2)
    return got.select("doc_id", "item_id", F.round("score", 6).alias("score"))


@query("best_seed", COPY_SQL + "SELECT doc_id, item_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, item_id) AS r FROM s WHERE score >= 0.2) WHERE r = 1")
def best_seed(spark, sf_dir: str) -> DataFrame:
    """The nearest held-out item of every document."""
    got = S.copy_scores(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text", 0.2)
    best = got.groupBy("doc_id").agg(F.min_by(F.struct("item_id", "score"), F.struct(-F.round("score", 9), F.col("item_id"))).alias("b"))
    return best.select("doc_id", "b.item_id", F.round("b.score", 6).alias("score"))



@query("anchor_contrast", COPY_SQL + """, r AS (SELECT doc_id, item_id, score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS k, count(*) OVER (PARTITION BY item_id) AS n FROM s WHERE score >= 0.2 AND score < 0.98)
SELECT item_id, min(doc_id) FILTER (WHERE k = 1) AS anchor, min(doc_id) FILTER (WHERE k = (n + 1) // 2) AS contrast, round(min(score) FILTER (WHERE k = (n + 1) // 2), 6) AS score FROM r GROUP BY item_id""")
def anchor_contrast(spark, sf_dir: str) -> DataFrame:
    """For each item its nearest document that is no copy, and the median one as contrast."""
    from pyspark.sql import Window

    got = S.copy_scores(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text", 0.2).filter("score < 0.98")
    w = Window.partitionBy("item_id")
    r = got.withColumn("k", F.row_number().over(w.orderBy(F.round("score", 9).desc(), "doc_id"))).withColumn("n", F.count("*").over(w))
    mid = F.col("k") == F.floor((F.col("n") + 1) / 2)
    return r.groupBy("item_id").agg(F.min(F.when(F.col("k") == 1, F.col("doc_id"))).alias("anchor"), F.min(F.when(mid, F.col("doc_id"))).alias("contrast"), F.round(F.min(F.when(mid, F.col("score"))), 6).alias("score"))


@query("catalog_filter", "SELECT DISTINCT subnode_id, msc_full FROM subnodes WHERE regexp_full_match(msc_full, '[0-9]{2}[A-Z][0-9]{2}') AND left(msc_full, 2) IN ('11', '05', '51', '26', '60', '15', '97') AND NOT ends_with(msc_full, '99') AND NOT regexp_matches(coalesce(concept_cluster, ''), '(?i)history|survey')")
def catalog_filter(spark, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "subnodes")
    ok = F.col("msc_full").rlike("^[0-9]{2}[A-Z][0-9]{2}$") & F.substring("msc_full", 1, 2).isin("11", "05", "51", "26", "60", "15", "97") & ~F.col("msc_full").endswith("99") & ~F.coalesce("concept_cluster", F.lit("")).rlike("(?i)history|survey")
    return s.filter(ok).select("subnode_id", "msc_full").distinct()


@query("code_kinds", "SELECT subnode_id, regexp_extract(coalesce(msc_full, ''), '([0-9]{2}[A-Z][0-9]{2})', 1) AS code, left(coalesce(msc_full, ''), 2) AS l1, CASE WHEN regexp_matches(coalesce(msc_full, ''), '^[0-9]{2}-XX$') THEN 'l1' WHEN regexp_matches(coalesce(msc_full, ''), '^[0-9]{2}[A-Z]xx$') THEN 'l2' WHEN regexp_matches(coalesce(msc_full, ''), '^[0-9]{2}[A-Z][0-9]{2}$') THEN 'full' ELSE 'none' END AS kind FROM subnodes")
def code_kinds(spark, sf_dir: str) -> DataFrame:
    c = F.coalesce("msc_full", F.lit(""))
    kind = F.when(c.rlike("^[0-9]{2}-XX$"), "l1").when(c.rlike("^[0-9]{2}[A-Z]xx$"), "l2").when(c.rlike("^[0-9]{2}[A-Z][0-9]{2}$"), "full").otherwise("none")
    return table(spark, sf_dir, "subnodes").select("subnode_id", T.subject_code(F.col("msc_full")).alias("code"), F.substring(c, 1, 2).alias("l1"), kind.alias("kind"))


@query("phrase_sets", r"SELECT subnode_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(regexp_replace(lower(coalesce(concept_cluster, '')), '[^\p{L}\p{N}| ]', ' ', 'g'), '|'), lambda x: regexp_replace(regexp_replace(x, '\s+', ' ', 'g'), '^ | $', '', 'g')), lambda x: x <> ''))), '|') AS phrases FROM subnodes")
def phrase_sets(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "subnodes").select("subnode_id", F.array_join(F.array_sort(T.phrases(F.col("concept_cluster"))), "|").alias("phrases"))


@query("shard_assign", "SELECT row_id, 'math_train_' || lpad(CAST((row_number() OVER (ORDER BY row_id) - 1) // 100 + 1 AS VARCHAR), 5, '0') AS shard_id FROM math_train")
def shard_assign(spark, sf_dir: str) -> DataFrame:
    """Rows in shards of exactly a hundred, in the order of their ids."""
    n = R.dense_id(table(spark, sf_dir, "math_train").select("row_id"), ["row_id"], "n")
    return n.select("row_id", F.format_string("math_train_%05d", (F.floor(F.col("n") / 100) + 1)).alias("shard_id"))


@query("resume_antijoin", """WITH p AS (SELECT s.refill_file, count(*) AS pending FROM synth_refill s WHERE NOT EXISTS (SELECT 1 FROM answered_rows a WHERE a.synth_id = s.synth_id) GROUP BY s.refill_file),
c AS (SELECT refill_file, count(*) AS rows_all FROM synth_refill GROUP BY refill_file) SELECT refill_file, rows_all, coalesce(pending, 0) AS pending, greatest(1, least(rows_all, (rows_all - coalesce(pending, 0)) // 100 - 1 + 1))::BIGINT AS start_shard FROM c LEFT JOIN p USING (refill_file) WHERE refill_file IS NOT NULL""")
def resume_antijoin(spark, sf_dir: str) -> DataFrame:
    """What is left to answer of each file, and the shard to resume at (one shard back)."""
    s = table(spark, sf_dir, "synth_refill").filter("refill_file is not null").select("refill_file", "synth_id")
    done = table(spark, sf_dir, "answered_rows").select("synth_id").filter("synth_id is not null").distinct().withColumn("done", F.lit(1))
    per = s.join(done, "synth_id", "left").groupBy("refill_file").agg(F.count("*").alias("rows_all"), F.count_if(F.col("done").isNull()).alias("pending"))
    return per.withColumn("start_shard", F.greatest(F.lit(1), F.least("rows_all", F.floor((F.col("rows_all") - F.col("pending")) / 100))).cast("long"))


@query("verdict_summary", "SELECT lower(trim(coalesce(verdict, ''))) AS verdict, count(*) AS rows_all, count(DISTINCT source_file) AS files, count(DISTINCT answer_id) AS answers FROM answered_rows GROUP BY 1")
def verdict_summary(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "answered_rows").groupBy(F.lower(F.trim(F.coalesce("verdict", F.lit("")))).alias("verdict")).agg(F.count("*").alias("rows_all"), F.countDistinct("source_file").alias("files"), F.countDistinct("answer_id").alias("answers"))


@query("answer_errors", V.ANSWER_SQL)
def answer_errors(spark, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "answered_rows").dropDuplicates(["answer_id"])
    return a.select("answer_id", V.answer_verdict().alias("verdict_fixed"), V.answer_error().alias("error"), F.least(F.size(F.coalesce("solution_steps", F.array())), F.lit(8)).alias("steps"))


@query("solution_text", r"SELECT DISTINCT answer_id, coalesce(array_to_string(list_transform(solution_steps, lambda s, i: i || '. ' || coalesce(regexp_replace(regexp_replace(s, '(?i)^[\s]*(step|步骤)\s*[0-9]+\s*[:.：、)]?\s*', ''), '^[\s\p{Z}\x0b\x{85}\x{1c}-\x{1f}]+|[\s\p{Z}\x0b\x{85}\x{1c}-\x{1f}]+$', '', 'g'), '')), chr(10)), '') AS solution FROM answered_rows")
def solution_text(spark, sf_dir: str) -> DataFrame:
    """Solution steps as numbered lines, without labels of their own."""
    steps = F.transform("solution_steps", lambda s: T.strip_step_label(s))
    return table(spark, sf_dir, "answered_rows").select("answer_id", F.coalesce(T.render_steps(steps), F.lit("")).alias("solution")).distinct()


@query("json_ladder")
def json_ladder(spark, sf_dir: str) -> DataFrame:
    """Each raw line's fields with the rung of the recovery ladder that read it."""
    from skeinworks.functions.ladder import parse_ladder

    return table(spark, sf_dir, "raw_lines").select("line_id", parse_ladder("raw_line").alias("r")).select("line_id", "r.mode", "r.problem", "r.level", "r.type", "r.solution")
