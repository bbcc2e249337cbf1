"""Whole batches: group rules over all rows of a file, slots along chains, and how planned seeds are used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.functions import text as T
from skeinworks.plans.graphs import CHAIN_SQL
from skeinworks.plans.registry import query
from skeinworks.plans.texts import SKELETON_SQL, norm_sql, seed_tokens_sql
from skeinworks.runtime import table

BATCH_ROWS, COPY = 100, 0.96
LEVELS = ("easy", "medium", "hard")
# Target difficulty and chain length of each level.
SPECS = {"easy": (0.30, 2), "medium": (0.55, 3), "hard": (0.80, 4)}

_SIM = "(CASE WHEN len(list_distinct(list_concat({a}, {b}))) > 0 THEN len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b})))::DOUBLE ELSE 0 END)"
BATCH_SQL = f"""WITH s AS (SELECT synth_id, refill_file, problem, lower(trim(coalesce(difficulty, ''))) AS level, {SKELETON_SQL} AS skeleton,
  list_distinct(list_filter(list_transform(coalesce(selected_seed_qids, []), lambda x: trim(x)), lambda x: x <> '')) AS seeds, list_distinct(list_filter(list_transform(coalesce(chain_subnodes, []), lambda x: trim(x)), lambda x: x <> '')) AS nodes
  FROM synth_refill WHERE refill_file IS NOT NULL),
g AS (SELECT refill_file, count(*) AS items, count(DISTINCT synth_id) AS slots, count_if(level = 'easy')::BIGINT AS easy, count_if(level = 'medium')::BIGINT AS medium, count_if(level = 'hard')::BIGINT AS hard, count_if(len(seeds) = 0)::BIGINT AS no_seed, count_if(len(nodes) = 0)::BIGINT AS no_node FROM s GROUP BY refill_file),
k AS (SELECT refill_file, sum(n - 1) AS repeated FROM (SELECT refill_file, skeleton, count(*) AS n FROM s WHERE len(string_split(skeleton, ' ')) >= 8 GROUP BY ALL) GROUP BY refill_file),
qs AS (SELECT refill_file, count(DISTINCT q) AS seeds FROM (SELECT refill_file, unnest(seeds) AS q FROM s) GROUP BY refill_file),
ns AS (SELECT refill_file, count(DISTINCT q) AS nodes FROM (SELECT refill_file, unnest(nodes) AS q FROM s) GROUP BY refill_file),
e AS (SELECT qid, {seed_tokens_sql('problem')} AS t, list_distinct(regexp_extract_all(coalesce(problem, ''), '[0-9]+')) AS d FROM math_seed),
p AS (SELECT synth_id, refill_file, {seed_tokens_sql('problem')} AS t, list_distinct(regexp_extract_all(coalesce(problem, ''), '[0-9]+')) AS d, seeds FROM s),
c AS (SELECT refill_file, count(DISTINCT synth_id) AS copies FROM (SELECT p.synth_id, p.refill_file, 0.75 * {_SIM.format(a='p.t', b='e.t')} + 0.25 * {_SIM.format(a='p.d', b='e.d')} AS score FROM (SELECT *, unnest(seeds) AS qid FROM p) p JOIN e USING (qid)) WHERE score >= {COPY} GROUP BY refill_file),
r AS (SELECT g.*, coalesce(repeated, 0)::BIGINT AS repeated, coalesce(seeds, 0) AS seeds, coalesce(nodes, 0) AS nodes, coalesce(copies, 0) AS copies FROM g LEFT JOIN k USING (refill_file) LEFT JOIN qs USING (refill_file) LEFT JOIN ns USING (refill_file) LEFT JOIN c USING (refill_file))
SELECT *, CASE WHEN items <> {BATCH_ROWS} THEN 'item_count' WHEN slots <> items THEN 'slots' WHEN easy + medium + hard <> items THEN 'difficulty' WHEN repeated > 0 THEN 'skeletons' WHEN no_seed > 0 THEN 'missing_seeds' WHEN no_node > 0 THEN 'missing_nodes' WHEN copies > 0 THEN 'too_close_to_seed' WHEN seeds < items THEN 'seed_coverage' END AS error FROM r
"""


def checked_batches(rows: DataFrame, seeds: DataFrame, size: int = BATCH_ROWS, copy: float = COPY) -> DataFrame:
    """Each batch's counts and the first rule that it breaks.

    rows: batch, id, level, problem, seeds, nodes (arrays). seeds: qid, problem. Counts of rows are partial sums; skeletons, seeds and
    nodes are counted by their own keys first, so no batch's texts or lists are gathered in one place.
    """
    level = lambda x: F.count_if(F.col("level") == x).alias(x)
    g = rows.groupBy("batch").agg(F.count("*").alias("items"), *(level(x) for x in LEVELS), F.count_if(F.size("seeds") == 0).alias("no_seed"), F.count_if(F.size("nodes") == 0).alias("no_node"))
    slots = rows.select("batch", "id").distinct().groupBy("batch").agg(F.count("*").alias("slots"))
    s = rows.select("batch", T.body_skeleton(F.col("problem")).alias("skeleton")).filter(F.size(F.split("skeleton", " ")) >= 8)
    repeated = s.groupBy("batch", "skeleton").agg(F.count("*").alias("n")).groupBy("batch").agg(F.sum(F.col("n") - 1).alias("repeated"))
    covered = lambda c: rows.select("batch", F.explode(c).alias("x")).distinct().groupBy("batch").agg(F.count("*").alias(c))
    features = lambda df: df.withColumn("t", T.seed_tokens(F.col("problem"))).withColumn("d", T.digit_runs(F.col("problem"))).drop("problem")
    own = features(rows.select("batch", "id", "problem", "seeds")).withColumn("qid", F.explode("seeds")).drop("seeds")
    near = own.join(features(seeds.select("qid", "problem")).withColumnsRenamed({"t": "t2", "d": "d2"}), "qid")
    score = 0.75 * T.jaccard(F.col("t"), F.col("t2")) + 0.25 * T.jaccard(F.col("d"), F.col("d2"))
    copies = near.filter(score >= copy).select("batch", "id").distinct().groupBy("batch").agg(F.count("*").alias("copies"))
    r = g
    for part in (slots, repeated, covered("seeds"), covered("nodes"), copies):
        r = r.join(part, "batch", "left")
    r = r.fillna(0, ["slots", "repeated", "seeds", "nodes", "copies"])
    error = (
        F.when(F.col("items") != size, "item_count").when(F.col("slots") != F.col("items"), "slots").when(F.col("easy") + F.col("medium") + F.col("hard") != F.col("items"), "difficulty")
        .when(F.col("repeated") > 0, "skeletons").when(F.col("no_seed") > 0, "missing_seeds").when(F.col("no_node") > 0, "missing_nodes").when(F.col("copies") > 0, "too_close_to_seed").when(F.col("seeds") < F.col("items"), "seed_coverage")
    )
    return r.withColumn("error", error)


@query("batch_check", BATCH_SQL)
def batch_check(spark, sf_dir: str) -> DataFrame:
    """Every file of new problems against the rules that hold for it as a whole."""
    s = table(spark, sf_dir, "synth_refill").filter("refill_file is not null")
    clean = lambda c: F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""))
    rows = s.select(F.col("refill_file").alias("batch"), F.col("synth_id").alias("id"), F.lower(F.trim(F.coalesce("difficulty", F.lit("")))).alias("level"), "problem", clean("selected_seed_qids").alias("seeds"), clean("chain_subnodes").alias("nodes"))
    return checked_batches(rows, table(spark, sf_dir, "math_seed")).withColumnRenamed("batch", "refill_file")


@query("difficulty_histogram", "SELECT chain_bucket, count_if(d = 'easy')::BIGINT AS easy, count_if(d = 'medium')::BIGINT AS medium, count_if(d = 'hard')::BIGINT AS hard, count_if(d NOT IN ('easy', 'medium', 'hard'))::BIGINT AS other FROM (SELECT lower(trim(coalesce(chain_bucket, ''))) AS chain_bucket, lower(trim(coalesce(difficulty, ''))) AS d FROM synth_refill) GROUP BY chain_bucket")
def difficulty_histogram(spark, sf_dir: str) -> DataFrame:
    clean = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    s = table(spark, sf_dir, "synth_refill").select(clean("chain_bucket").alias("chain_bucket"), clean("difficulty").alias("d"))
    return s.groupBy("chain_bucket").agg(*(F.count_if(F.col("d") == x).alias(x) for x in LEVELS), F.count_if(~F.col("d").isin(*LEVELS)).alias("other"))


@query(
    "slot_execution",
    """WITH c AS (SELECT synth_id, list_transform(chain_subnodes, lambda x: trim(x)) AS chain, edge_types AS t FROM synth_refill WHERE len(chain_subnodes) = len(edge_types) + 1 AND len(chain_subnodes) >= 2),
v AS (SELECT *, least(want, len(chain)) AS width FROM (SELECT c.*, slot.slot_id, slot.difficulty, slot.want FROM c, (VALUES (1, 'easy', 2), (2, 'medium', 3), (3, 'hard', 4)) AS slot(slot_id, difficulty, want))),
w AS (SELECT *, chain[i:i + width - 1] AS nodes, t[i:i + width - 2] AS types FROM (SELECT *, unnest(range(1, len(chain) - width + 2)) AS i FROM v)),
k AS (SELECT *, row_number() OVER (PARTITION BY synth_id, slot_id ORDER BY len(list_filter(types, lambda x: x = 'pre')) DESC, len(list_filter(types, lambda x: x IN ('sem', 'main_sem'))) DESC, i) AS r, count(*) OVER (PARTITION BY synth_id, slot_id) AS n FROM w)
SELECT synth_id, slot_id::INT AS slot_id, difficulty, array_to_string(nodes, '>') AS backbone, array_to_string(list_sort(list_distinct(list_filter(chain, lambda x: NOT list_contains(nodes, x)))), ',') AS auxiliary, array_to_string(types, ',') AS handoffs FROM k WHERE r = (slot_id - 1) % n + 1""",
)
def slot_execution(spark, sf_dir: str) -> DataFrame:
    """Three slots of each chain: a window of the level's length as backbone, the rest as auxiliary nodes, the edges between as hand-offs.

    Windows are ranked by pre edges, then semantic ones, then place, and slots take them in turn: all within the row.
    """
    s = table(spark, sf_dir, "synth_refill").filter((F.size("chain_subnodes") == F.size("edge_types") + 1) & (F.size("chain_subnodes") >= 2))
    s = s.select("synth_id", F.transform("chain_subnodes", lambda x: F.trim(x)).alias("chain"), F.col("edge_types").alias("t"))
    slots = F.array(*(F.struct(F.lit(k + 1).alias("slot_id"), F.lit(x).alias("difficulty"), F.lit(SPECS[x][1]).alias("want")) for k, x in enumerate(LEVELS)))
    s = s.withColumn("s", F.explode(slots)).select("synth_id", "chain", "t", "s.*").withColumn("width", F.least("want", F.size("chain")))
    of = lambda i, *kinds: F.size(F.filter(F.slice("t", i, F.col("width") - 1), lambda x: x.isin(*kinds)))
    windows = F.array_sort(F.transform(F.sequence(F.lit(1), F.size("chain") - F.col("width") + 1), lambda i: F.struct((-of(i, "pre")).alias("p"), (-of(i, "sem", "main_sem")).alias("m"), i.alias("i"))))
    s = s.withColumn("w", windows).withColumn("i", F.element_at("w", F.pmod(F.col("slot_id") - 1, F.size("w")) + 1)["i"])
    nodes = F.slice("chain", F.col("i"), F.col("width"))
    return s.select("synth_id", "slot_id", "difficulty", F.array_join(nodes, ">").alias("backbone"), F.array_join(F.array_sort(F.array_except("chain", nodes)), ",").alias("auxiliary"), F.array_join(F.slice("t", F.col("i"), F.col("width") - 1), ",").alias("handoffs"))


@query(
    "seed_usage_plan",
    """WITH s AS (SELECT synth_id, list_transform(chain_subnodes, lambda x: trim(x)) AS nodes, seed_role_pack.anchor.qid AS anchor, list_filter(list_transform(coalesce(selected_seed_qids, []), lambda x: trim(x)), lambda x: x <> '') AS q FROM synth_refill WHERE len(chain_subnodes) > 0),
d AS (SELECT synth_id, nodes, qid, min(pos) AS first FROM (SELECT synth_id, nodes, q[pos] AS qid, pos FROM (SELECT *, unnest(range(1, len(q) + 1)) AS pos FROM s) UNION ALL SELECT synth_id, nodes, anchor, 1000000 FROM s WHERE trim(anchor) <> '') GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY synth_id ORDER BY first) - 1 AS place FROM d)
SELECT synth_id, place::INT AS place, qid, nodes[place % len(nodes) + 1] AS node, (place % 4 + 1)::INT AS step FROM p""",
)
def seed_usage_plan(spark, sf_dir: str) -> DataFrame:
    """Each row's seeds once, the anchor appended where it is missing, dealt to nodes and to four steps in turn: within the row."""
    s = table(spark, sf_dir, "synth_refill").filter(F.size("chain_subnodes") > 0)
    listed = F.filter(F.transform(F.coalesce("selected_seed_qids", F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    anchor = F.col("seed_role_pack.anchor.qid")
    planned = F.array_distinct(F.concat(listed, F.when(F.trim(anchor) != "", F.array(anchor)).otherwise(F.array().cast("array<string>"))))
    s = s.select("synth_id", F.transform("chain_subnodes", lambda x: F.trim(x)).alias("nodes"), F.posexplode(planned).alias("place", "qid"))
    return s.select("synth_id", "place", "qid", F.element_at("nodes", F.pmod("place", F.size("nodes")) + 1).alias("node"), (F.pmod("place", F.lit(4)) + 1).alias("step"))


@query("slot_drops", """WITH s AS (SELECT synth_id, refill_file, lower(trim(coalesce(difficulty, ''))) AS level, regexp_matches(coalesce(problem, ''), '[^\\s]') AS active FROM synth_refill WHERE refill_file IS NOT NULL),
a AS (SELECT * FROM s WHERE active)
SELECT s.refill_file, (count(*) - count_if(active))::BIGINT AS dropped, count_if(active)::BIGINT AS active, count_if(active AND level = 'easy')::BIGINT AS easy, count_if(active AND level = 'medium')::BIGINT AS medium, count_if(active AND level = 'hard')::BIGINT AS hard,
 (SELECT count(*) FROM answered_rows r JOIN a ON a.synth_id = r.synth_id WHERE a.refill_file = s.refill_file) AS answers FROM s GROUP BY s.refill_file""")
def slot_drops(spark, sf_dir: str) -> DataFrame:
    """Slots without a problem are dropped from every row set of their file, and its counts made anew."""
    s = table(spark, sf_dir, "synth_refill").filter("refill_file is not null").select("synth_id", "refill_file", F.lower(F.trim(F.coalesce("difficulty", F.lit("")))).alias("level"), F.coalesce("problem", F.lit("")).rlike(r"[^\s]").alias("active"))
    answers = table(spark, sf_dir, "answered_rows").filter("synth_id is not null").groupBy("synth_id").agg(F.count("*").alias("n"))
    on = F.col("active")
    g = s.join(answers, "synth_id", "left")
    return g.groupBy("refill_file").agg(F.count_if(~on).alias("dropped"), F.count_if(on).alias("active"), *(F.count_if(on & (F.col("level") == x)).alias(x) for x in LEVELS), F.coalesce(F.sum(F.when(on, F.col("n"))), F.lit(0)).alias("answers"))


@query("level_numbers", r"SELECT qid, coalesce(try_cast(regexp_extract(level, '([0-9]+)', 1) AS INT), 0) AS number, length(left(coalesce(problem, ''), 120)) AS shown, left(coalesce(answer, ''), 8) AS cut FROM math_seed")
def level_numbers(spark, sf_dir: str) -> DataFrame:
    """Levels as numbers, and texts cut for a prompt."""
    s = table(spark, sf_dir, "math_seed")
    return s.select("qid", T.level_number(F.col("level")).alias("number"), F.length(T.prompt_cut(F.col("problem"), 120)).cast("long").alias("shown"), T.prompt_cut(F.col("answer"), 8).alias("cut"))


@query("tagged_questions", rf"SELECT row_id, coalesce(regexp_replace(problem, '^[\s\p{{Z}}\x0b\x{{85}}\x{{1c}}-\x{{1f}}]+|[\s\p{{Z}}\x0b\x{{85}}\x{{1c}}-\x{{1f}}]+$', '', 'g'), '') AS question FROM math_train")
def tagged_questions(spark, sf_dir: str) -> DataFrame:
    """Problems with and without tags around them come out alike."""
    m = table(spark, sf_dir, "math_train")
    text = F.when(F.col("difficulty").isNull() | ~F.col("problem").rlike(r"[^\s\p{Z}]"), F.col("problem")).otherwise(F.concat(F.lit("so <q>"), "problem", F.lit("</Q> <Q>other</Q>")))
    return m.select("row_id", T.tagged_question(text).alias("question"))


@query("chain_features", """WITH c AS (SELECT synth_id, chain_avg_difficulty AS node, edge_confs AS confs, len(chain_subnodes) AS m, len(list_filter(edge_types, lambda x: x = 'main_sem')) AS switches FROM synth_refill WHERE len(chain_subnodes) = len(edge_types) + 1 AND chain_avg_difficulty IS NOT NULL),
j AS (SELECT *, CASE WHEN len(confs) > 0 THEN list_sum(list_transform(confs, lambda x: 1 - coalesce(x, 0))) / len(confs) ELSE 0.5 END AS jump FROM c)
SELECT synth_id, CASE WHEN m >= 2 THEN round(greatest(0, least(1, 0.55 * node + 0.15 * greatest(0, least(1, (m - 2) / 2.0)) + 0.15 * jump + 0.15 * switches / (m - 1))), 6) END AS difficulty FROM j""")
def chain_features(spark, sf_dir: str) -> DataFrame:
    """Each chain's difficulty from its nodes, length, sureness and crossings."""
    s = table(spark, sf_dir, "synth_refill").filter((F.size("chain_subnodes") == F.size("edge_types") + 1) & F.col("chain_avg_difficulty").isNotNull())
    switches = F.size(F.filter("edge_types", lambda x: x == "main_sem"))
    return s.select("synth_id", F.round(T.chain_difficulty(F.col("chain_avg_difficulty"), F.col("edge_confs"), switches, F.size("chain_subnodes")), 6).alias("difficulty"))


@query("edge_widths", "WITH " + CHAIN_SQL + """, b AS (SELECT type, ln(1 + min(cooccur)) AS lo, ln(1 + max(cooccur)) AS hi FROM chain_edges GROUP BY type)
SELECT src, dst, type, round(CASE WHEN hi - lo < 1e-12 THEN 2.3 ELSE 0.6 + (ln(1 + cooccur) - lo) / (hi - lo) * 3.4 END, 6) AS width FROM chain_edges JOIN b USING (type)""")
def edge_widths(spark, sf_dir: str) -> DataFrame:
    """Line widths of edges by how often they occur, scaled within their type (three rows, so the bounds are broadcast by size)."""
    from skeinworks.plans.graphs import chain_edges

    e = chain_edges(spark, sf_dir)
    bounds = e.groupBy("type").agg(F.log1p(F.min("cooccur")).alias("lo"), F.log1p(F.max("cooccur")).alias("hi"))
    return e.join(bounds, "type").select("src", "dst", "type", F.round(T.scale_widths(F.col("cooccur"), F.col("lo"), F.col("hi"), 0.6, 4.0), 6).alias("width"))


NUMERIC = r"\b(how many|number of|find the value|remainder|what is)\b"
OPEN = r"\b(in terms of|express|prove|show that|all possible|describe)\b"


@query("open_goals", rf"""WITH p AS (SELECT row_id, coalesce(problem, '') AS p FROM math_train),
f AS (SELECT row_id, p, list_distinct(list_filter(list_transform(flatten(list_transform(list_concat(regexp_extract_all(p, '{T.DECLARED[0]}', 1), regexp_extract_all(p, '{T.DECLARED[1]}', 1)), lambda x: string_split(x, ','))), lambda x: trim(x)), lambda x: x <> '')) AS d, list_distinct(regexp_extract_all(p, '{T.ASSIGNED}', 1)) AS a FROM p)
SELECT row_id, regexp_matches({norm_sql('p')}, '{NUMERIC}') AND NOT regexp_matches({norm_sql('p')}, '{OPEN}') AND len(d) >= 2 AND len(list_filter(d, lambda x: NOT list_contains(a, x))) >= 2 AS open_goal FROM f""")
def open_goals(spark, sf_dir: str) -> DataFrame:
    """Problems that ask for a number while two or more of their declared symbols have no value."""
    return table(spark, sf_dir, "math_train").select("row_id", T.numeric_goal_with_free_symbols(F.col("problem"), NUMERIC, OPEN).alias("open_goal"))


@query("given_targets", rf"""WITH c AS (SELECT row_id, list_filter(list_transform(string_split({norm_sql('problem')}, '. '), lambda x: trim(x)), lambda x: x <> '') AS c FROM math_train)
SELECT row_id, len(c)::INT AS clauses, len(c) > 1 AND length(c[-1]) >= 6 AND len(list_filter(c[1:len(c) - 1], lambda x: contains(x, c[-1]))) > 0 AS given FROM c""")
def given_targets(spark, sf_dir: str) -> DataFrame:
    """Problems whose last clause (what is asked) stands in an earlier one."""
    c = F.filter(F.transform(F.split(T.normalize_text(F.col("problem")), r"\. "), lambda x: F.trim(x)), lambda x: x != "")
    m = table(spark, sf_dir, "math_train").select("row_id", c.alias("c"))
    return m.select("row_id", F.size("c").alias("clauses"), T.target_given(F.element_at(F.when(F.size("c") > 0, F.col("c")).otherwise(F.array(F.lit(""))), -1), F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0)))).alias("given"))


@query("concept_hits", rf"""WITH a AS (SELECT DISTINCT qid, subject, concepts, problem FROM audit_relevance),
c AS (SELECT qid, subject, concepts, problem, {norm_sql('problem')} AS p, list_distinct(list_filter(list_transform(regexp_split_to_array(coalesce(concepts, ''), '[|;]'), lambda x: {norm_sql('x')}), lambda x: x <> '')) AS k FROM a)
SELECT qid, len(k)::INT AS concepts, len(list_filter(k, lambda x: contains(p, x)))::INT AS in_problem, len(list_filter(k, lambda x: len(list_filter(string_split(x, ' '), lambda w: length(w) >= 4 AND contains(p, w))) > 0))::INT AS word_in_problem, len(list_filter(string_split(p, ' '), lambda w: w <> ''))::INT AS words FROM c""")
def concept_hits(spark, sf_dir: str) -> DataFrame:
    """How many of a question's concepts stand in its problem, whole or by a word of at least four letters, and the problem's words."""
    a = table(spark, sf_dir, "audit_relevance").select("qid", "subject", "concepts", "problem").distinct()
    k = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("concepts", F.lit("")), "[|;]"), T.normalize_text), lambda x: x != ""))
    a = a.select("qid", T.normalize_text(F.col("problem")).alias("p"), k.alias("k"))
    by_word = F.filter("k", lambda x: F.exists(F.split(x, " "), lambda w: (F.length(w) >= 4) & F.col("p").contains(w)))
    return a.select("qid", F.size("k").alias("concepts"), F.size(F.filter("k", lambda x: F.col("p").contains(x))).alias("in_problem"), F.size(by_word).alias("word_in_problem"), F.size(F.filter(F.split("p", " "), lambda w: w != "")).alias("words"))


@query(
    "seed_rotation",
    """WITH s AS (SELECT synth_id, list_distinct(list_filter(list_transform(coalesce(selected_seed_qids, []), lambda x: trim(x)), lambda x: x <> '')) AS d, list_filter(list_transform(coalesce(selected_seed_qids, []), lambda x: trim(x)), lambda x: x <> '') AS q FROM synth_refill WHERE len(chain_subnodes) > 0),
o AS (SELECT synth_id, list_sort(list_transform(d, lambda x: {'p': list_position(q, x), 'x': x})) AS o, len(d) AS n FROM s)
SELECT synth_id, slot.slot_id::INT AS slot_id, least(slot.want, n)::INT AS seeds, coalesce(o[slot.slot_id].x, o[1].x) AS first FROM o, (VALUES (1, 1), (2, 2), (3, 3)) AS slot(slot_id, want)""",
)
def seed_rotation(spark, sf_dir: str) -> DataFrame:
    """How many seeds each of three slots gets, and its first one: the next of the batch, from the start again once all are used."""
    from skeinworks.operators.sampling import rotate_seeds

    s = table(spark, sf_dir, "synth_refill").filter(F.size("chain_subnodes") > 0)
    seeds = F.array_distinct(F.filter(F.transform(F.coalesce("selected_seed_qids", F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""))
    empty = F.array().cast("array<string>")
    slots = F.array(*(F.struct(F.lit(x).alias("difficulty"), empty.alias("backbone")) for x in LEVELS))
    b = s.select(F.col("synth_id").alias("id"), seeds.alias("seeds"), empty.alias("seed_nodes"), empty.alias("nodes"), slots.alias("slots"))
    return rotate_seeds(b).select(F.col("id").alias("synth_id"), "slot_id", F.size("seeds").alias("seeds"), F.get("seeds", F.lit(0)).alias("first"))
