"""Seeds, roles, slots and starts along chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinworks.functions import text as T
from skeinworks.operators import relational as R
from skeinworks.operators.sampling import cluster_groups, shuffled_first, softmax_choice
from skeinworks.plans.graphs import CHAIN_SQL, chain_edges
from skeinworks.plans.registry import query
from skeinworks.plans.seeds import INDEX_SQL, mentions, seed_index
from skeinworks.runtime import table

LEVEL = "try_cast(regexp_extract(s.level, '([1-5])', 1) AS INT)"


def _levels(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "math_seed").select("qid", F.coalesce(F.regexp_extract("level", "([1-5])", 1).try_cast("int"), F.lit(0)).alias("level"))


@query(
    "seed_roles",
    f"""WITH a AS (SELECT synth_id, seed_role_pack.anchor.qid AS anchor, seed_role_pack.contrast.qid AS contrast, selected_seed_qids AS q FROM synth_refill),
    l AS (SELECT qid, coalesce({LEVEL}, 0) AS level FROM math_seed s)
    SELECT synth_id, anchor, contrast, coalesce(x.level, 0)::INT AS anchor_level, coalesce(y.level, 0)::INT AS contrast_level, coalesce(list_contains(q, anchor), false) AS anchor_used, coalesce(len(list_distinct(list_filter(q, z: z <> anchor AND z <> coalesce(contrast, '')))), 0)::INT AS support
    FROM a LEFT JOIN l x ON x.qid = anchor LEFT JOIN l y ON y.qid = contrast""".replace("z: z", "lambda z: z"),
)
def seed_roles(spark, sf_dir: str) -> DataFrame:
    """Anchor and contrast of each row with their levels, and how many other seeds support them."""
    s = table(spark, sf_dir, "synth_refill").select("synth_id", F.col("seed_role_pack.anchor.qid").alias("anchor"), F.col("seed_role_pack.contrast.qid").alias("contrast"), F.col("selected_seed_qids").alias("q"))
    others = F.array_distinct(F.filter("q", lambda z: (z != F.col("anchor")) & (z != F.coalesce("contrast", F.lit("")))))
    s = s.select("synth_id", "anchor", "contrast", F.coalesce(F.array_contains("q", F.col("anchor")), F.lit(False)).alias("anchor_used"), F.coalesce(F.size(others), F.lit(0)).alias("support"))
    s = s.withColumn("support", F.greatest("support", F.lit(0)))
    for side in ("anchor", "contrast"):
        s = s.join(_levels(spark, sf_dir).select(F.col("qid").alias(side), F.col("level").alias(f"{side}_level")), side, "left").withColumn(f"{side}_level", F.coalesce(f"{side}_level", F.lit(0)))
    return s.select("synth_id", "anchor", "contrast", "anchor_level", "contrast_level", "anchor_used", "support")


@query(
    "seed_bank",
    "WITH " + INDEX_SQL + f""", c AS (SELECT DISTINCT synth_id, pos, trim(chain_subnodes[pos]) AS subnode_id FROM (SELECT synth_id, chain_subnodes, unnest(range(1, len(chain_subnodes) + 1)) AS pos FROM synth_refill)),
    j AS (SELECT c.synth_id, c.subnode_id, i.qid, {LEVEL} AS level, row_number() OVER (PARTITION BY c.synth_id, i.qid ORDER BY pos) AS first FROM c JOIN idx i USING (subnode_id) JOIN math_seed s ON s.qid = i.qid WHERE {LEVEL} = 5)
    SELECT synth_id, count(*) AS seeds, min(qid) AS first_seed FROM j WHERE first = 1 GROUP BY synth_id""",
)
def seed_bank(spark, sf_dir: str) -> DataFrame:
    """The hardest seeds at hand along each chain, each counted at the first subnode that has it."""
    c = table(spark, sf_dir, "synth_refill").select("synth_id", F.explode("chain_subnodes").alias("s")).select("synth_id", F.trim("s").alias("subnode_id")).distinct()
    hard = seed_index(spark, sf_dir).join(_levels(spark, sf_dir).filter("level = 5"), "qid").select("subnode_id", "qid")
    return c.join(hard, "subnode_id").select("synth_id", "qid").distinct().groupBy("synth_id").agg(F.count("*").alias("seeds"), F.min("qid").alias("first_seed"))


@query(
    "slot_plan",
    "SELECT synth_id, slot_id, trim(chain_subnodes[(slot_id - 1) % len(chain_subnodes) + 1]) AS node, selected_seed_qids[(slot_id - 1) % len(selected_seed_qids) + 1] AS seed FROM (SELECT synth_id, chain_subnodes, selected_seed_qids, unnest([1, 2, 3, 4, 5])::INT AS slot_id FROM synth_refill WHERE len(chain_subnodes) > 0 AND len(selected_seed_qids) > 0)",
)
def slot_plan(spark, sf_dir: str) -> DataFrame:
    """Five slots of each row, nodes and seeds dealt in turn: within the row, without a shuffle."""
    s = table(spark, sf_dir, "synth_refill").filter((F.size("chain_subnodes") > 0) & (F.size("selected_seed_qids") > 0))
    s = s.select("synth_id", "chain_subnodes", "selected_seed_qids", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("slot_id"))
    deal = lambda c: F.element_at(c, F.pmod(F.col("slot_id") - 1, F.size(c)) + 1)
    return s.select("synth_id", "slot_id", F.trim(deal("chain_subnodes")).alias("node"), deal("selected_seed_qids").alias("seed"))


@query("handoffs", "WITH " + CHAIN_SQL + "SELECT type, count(*) AS n, count(DISTINCT src || '>' || dst) AS pairs, round(avg(conf), 6) AS mean_conf, round(min(conf), 6) AS least FROM good GROUP BY type")
def handoffs(spark, sf_dir: str) -> DataFrame:
    from skeinworks.plans.graphs import chain_steps

    return chain_steps(spark, sf_dir).groupBy("type").agg(F.count("*").alias("n"), F.countDistinct("src", "dst").alias("pairs"), F.round(F.avg("conf"), 6).alias("mean_conf"), F.round(F.min("conf"), 6).alias("least"))


@query(
    "edge_select",
    "WITH " + CHAIN_SQL + "SELECT src, dst, type, round(conf, 6) AS conf FROM chain_edges WHERE conf >= 0.6 ORDER BY round(chain_edges.conf, 9) DESC, src, dst, type LIMIT 300",
)
def edge_select(spark, sf_dir: str) -> DataFrame:
    """The 300 surest chain edges (a top-k report)."""
    e = chain_edges(spark, sf_dir).filter("conf >= 0.6").orderBy(F.round("conf", 9).desc(), "src", "dst", "type").limit(300)
    return e.select("src", "dst", "type", F.round("conf", 6).alias("conf"))


@query(
    "cover_adjacency",
    "WITH " + CHAIN_SQL + """, m AS (SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY round(conf, 9) DESC, dst) AS r FROM chain_edges WHERE type = 'main_sem') WHERE r <= 3),
    u AS (SELECT src, dst FROM chain_edges WHERE type <> 'main_sem' UNION SELECT src, dst FROM m),
    o AS (SELECT src AS node, count(*) AS onward FROM u GROUP BY src), i AS (SELECT dst AS node, count(*) AS back FROM u GROUP BY dst)
    SELECT node, coalesce(onward, 0) AS onward, coalesce(back, 0) AS back FROM o FULL JOIN i USING (node)""",
)
def cover_adjacency(spark, sf_dir: str) -> DataFrame:
    """Numbers of neighbours onward and back, over pre and sem edges and each node's three best bridges."""
    e = chain_edges(spark, sf_dir)
    main = R.top_k(e.filter("type = 'main_sem'"), ["src"], [F.round("conf", 9).desc(), F.col("dst")], 3).select("src", "dst")
    u = e.filter("type <> 'main_sem'").select("src", "dst").unionByName(main).distinct()
    ends = u.select(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("b")).unionByName(u.select(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("b")))
    return ends.groupBy("node").agg(F.sum("o").alias("onward"), F.sum("b").alias("back"))


@query(
    "chain_score",
    "WITH " + CHAIN_SQL.rsplit(",\nchain_edges", 1)[0] + """, cv AS (SELECT node, count(*) AS cover FROM (SELECT synth_id, src AS node FROM good UNION SELECT synth_id, dst FROM good) GROUP BY node),
    nd AS (SELECT DISTINCT synth_id, node FROM (SELECT synth_id, src AS node FROM good UNION ALL SELECT synth_id, dst FROM good)),
    a AS (SELECT synth_id, sum(1 / sqrt(1 + cover)) AS gain FROM nd JOIN cv USING (node) GROUP BY synth_id),
    b AS (SELECT synth_id, avg(CASE WHEN type = 'pre' THEN 1.0 ELSE 0.0 END) AS pre, max((type = 'main_sem')::INT) AS main, min(conf) AS floor_conf FROM good GROUP BY synth_id)
    SELECT synth_id, round(gain + pre + 0.5 * main + floor_conf, 6) AS score FROM a JOIN b USING (synth_id)""",
)
def chain_score(spark, sf_dir: str) -> DataFrame:
    """Coverage gain + share of pre + half for a bridge + least confidence of each chain."""
    from skeinworks.plans.graphs import chain_steps

    g = chain_steps(spark, sf_dir)
    nodes = g.select("synth_id", F.explode(F.array("src", "dst")).alias("node")).distinct()
    cover = nodes.groupBy("node").agg(F.count("*").alias("cover"))
    gain = nodes.join(cover, "node").groupBy("synth_id").agg(F.sum(1 / F.sqrt(1 + F.col("cover"))).alias("gain"))
    rest = g.groupBy("synth_id").agg(F.avg(F.when(F.col("type") == "pre", 1.0).otherwise(0.0)).alias("pre"), F.max((F.col("type") == "main_sem").cast("int")).alias("main"), F.min("conf").alias("floor_conf"))
    return gain.join(rest, "synth_id").select("synth_id", F.round(F.col("gain") + F.col("pre") + 0.5 * F.col("main") + F.col("floor_conf"), 6).alias("score"))


@query(
    "candidate_merge",
    """WITH c AS (SELECT subnode_id, domain, msc_full, freq FROM subnodes WHERE domain IS NOT NULL),
    s AS (SELECT domain, subnode_id, 1 AS src, row_number() OVER (PARTITION BY domain ORDER BY freq DESC, subnode_id) AS r FROM c),
    g AS (SELECT subnode_id, row_number() OVER (ORDER BY freq DESC, subnode_id) AS r FROM c),
    u AS (SELECT domain, subnode_id, src * 1000 + r AS k FROM s WHERE r <= 5 UNION ALL SELECT d.domain, g.subnode_id, 2000 + g.r FROM (SELECT DISTINCT domain FROM c) d, g WHERE g.r <= 8),
    m AS (SELECT domain, subnode_id, min(k) AS k FROM u GROUP BY ALL)
    SELECT domain, subnode_id, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY k) AS rank FROM m) WHERE rank <= 10""",
)
def candidate_merge(spark, sf_dir: str) -> DataFrame:
    """Ten candidates for each domain: its own five most frequent subnodes first, then the most frequent of all."""
    c = table(spark, sf_dir, "subnodes").filter("domain is not null").select("subnode_id", "domain", "freq")
    own = R.top_k(c, ["domain"], [F.col("freq").desc(), F.col("subnode_id")], 5, "r").select("domain", "subnode_id", (F.col("r") + 1000).alias("k"))
    best = c.orderBy(F.col("freq").desc(), "subnode_id").limit(8).withColumn("r", F.row_number().over(Window.orderBy(F.col("freq").desc(), "subnode_id")))
    every = best.agg(F.collect_list(F.struct("subnode_id", "r")).alias("b"))  # one row of eight
    rest = c.select("domain").distinct().join(F.broadcast(every)).select("domain", F.explode("b").alias("b")).select("domain", "b.subnode_id", (F.col("b.r") + 2000).alias("k"))
    merged = own.unionByName(rest).groupBy("domain", "subnode_id").agg(F.min("k").alias("k"))
    return R.top_k(merged, ["domain"], [F.col("k")], 10).select("domain", "subnode_id", "rank")


@query(
    "bucket_transitions",
    "WITH t AS (SELECT lower(trim(coalesce(chain_bucket, ''))) AS old, CASE WHEN chain_avg_difficulty < 0.38 THEN 'low' WHEN chain_avg_difficulty < 0.68 THEN 'mid' ELSE 'high' END AS new FROM synth_refill WHERE chain_avg_difficulty IS NOT NULL) SELECT old, new, count(*) AS n, round(count(*) / (SELECT count(*) FROM t)::DOUBLE, 6) AS share FROM t WHERE old <> new GROUP BY ALL ORDER BY n DESC, old, new LIMIT 20",
)
def bucket_transitions(spark, sf_dir: str) -> DataFrame:
    """The twenty most frequent changes if buckets followed the mean difficulty (a top-k report)."""
    d = F.col("chain_avg_difficulty")
    t = table(spark, sf_dir, "synth_refill").filter(d.isNotNull()).select(F.lower(F.trim(F.coalesce("chain_bucket", F.lit("")))).alias("old"), F.when(d < 0.38, "low").when(d < 0.68, "mid").otherwise("high").alias("new"))
    counted = t.groupBy("old", "new").agg(F.count("*").alias("n"))
    whole = counted.agg(F.sum("n").alias("all"))
    return counted.filter("old <> new").join(F.broadcast(whole)).orderBy(F.col("n").desc(), "old", "new").limit(20).select("old", "new", "n", F.round(F.col("n") / F.col("all"), 6).alias("share"))


@query(
    "blank_rates",
    "SELECT lower(trim(coalesce(answer_model, ''))) AS model, count(*) AS rows_all, round(avg((trim(coalesce(final_answer, '')) = '')::INT), 6) AS blank_final, round(avg((coalesce(len(solution_steps), 0) = 0)::INT), 6) AS no_steps, round(avg((answer_finish_reason = 'length')::INT), 6) AS cut FROM answered_rows GROUP BY 1",
)
def blank_rates(spark, sf_dir: str) -> DataFrame:
    """Shares of rows of each model that lack something."""
    share = lambda c: F.round(F.avg(c.cast("int")), 6)
    a = table(spark, sf_dir, "answered_rows")
    return a.groupBy(F.lower(F.trim(F.coalesce("answer_model", F.lit("")))).alias("model")).agg(F.count("*").alias("rows_all"), share(F.trim(F.coalesce("final_answer", F.lit(""))) == "").alias("blank_final"), share(F.size(F.coalesce("solution_steps", F.array())) == 0).alias("no_steps"), share(F.col("answer_finish_reason") == "length").alias("cut"))


@query(
    "prompt_lines",
    "SELECT subnode_id, concat_ws(' / ', subnode_id, coalesce(parent_node_id, ''), coalesce(nullif(msc_full, ''), 'none'), coalesce(domain, 'none'), CASE WHEN length(trim(coalesce(concept_cluster, ''))) <= 40 THEN trim(coalesce(concept_cluster, '')) ELSE substr(trim(concept_cluster), 1, 37) || '...' END) AS line FROM subnodes",
)
def prompt_lines(spark, sf_dir: str) -> DataFrame:
    """One line of text for every subnode, long labels cut."""
    s = table(spark, sf_dir, "subnodes")
    code = F.when(F.coalesce("msc_full", F.lit("")) == "", "none").otherwise(F.col("msc_full"))
    return s.select("subnode_id", F.concat_ws(" / ", "subnode_id", F.coalesce("parent_node_id", F.lit("")), code, F.coalesce("domain", F.lit("none")), T.short(F.col("concept_cluster"), 40)).alias("line"))


@query("start_choice")
def start_choice(spark, sf_dir: str) -> DataFrame:
    """A start of each domain drawn with softmax odds that favour rarely covered subnodes (seeded)."""
    cover = seed_index(spark, sf_dir).groupBy("subnode_id").agg(F.count("*").alias("cover"))
    s = table(spark, sf_dir, "subnodes").filter("domain is not null").select("subnode_id", "domain").join(cover, "subnode_id", "left")
    return softmax_choice(s.withColumn("score", -0.5 * F.log1p(F.coalesce("cover", F.lit(0)))), ["domain"], "subnode_id", "score", 1.0, 7)


@query("seed_fill")
def seed_fill(spark, sf_dir: str) -> DataFrame:
    """Up to six seeds of each subnode: the least of every level, then others in a seeded order."""
    i = seed_index(spark, sf_dir).join(_levels(spark, sf_dir), "qid")
    first = i.filter("level > 0").groupBy("subnode_id", "level").agg(F.min("qid").alias("qid")).select("subnode_id", "qid", F.lit(0).alias("kind"))
    rest = shuffled_first(i.join(first, ["subnode_id", "qid"], "left_anti"), ["subnode_id"], "qid", 6, 7).select("subnode_id", "qid", "rank").withColumnRenamed("rank", "kind")
    return R.top_k(first.unionByName(rest), ["subnode_id"], [F.col("kind"), F.col("qid")], 6).select("subnode_id", "qid", "rank")


@query("concept_clusters")
def concept_clusters(spark, sf_dir: str) -> DataFrame:
    """Concepts of each subject in twelve clusters, each labelled by its three most frequent concepts."""
    c = mentions(spark, sf_dir).filter("subject is not null").groupBy("subject", "concept").agg(F.count("*").alias("freq")).withColumn("terms", F.split("concept", " "))
    placed = cluster_groups(c, "subject", "concept", "terms", "freq", 12).join(c.select("subject", "concept", "freq"), ["subject", "concept"])
    best = R.top_k(placed, ["subject", "cluster"], [F.col("freq").desc(), F.col("concept")], 3)
    label = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "concept"))), lambda x: x["concept"]), " | ")
    return best.groupBy("subject", "cluster").agg(label.alias("label")).join(placed.groupBy("subject", "cluster").agg(F.count("*").alias("concepts"), F.sum("freq").alias("freq")), ["subject", "cluster"])
