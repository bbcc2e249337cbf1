"""Edges of a two-level concept graph, bounded traversals and beam search, as joins of a fixed or converging number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks import runtime
from skeinworks.functions import text as T
from skeinworks.operators.components import connected_components
from skeinworks.operators.relational import remap, top_k


def prerequisite_edges(pairs: DataFrame, min_cooccur: int, min_sim: float, min_gap: float) -> DataFrame:
    """src, dst, conf of pairs (parent, a, b, cooccur, sim, da, db) whose difficulty gap sets a direction.

    A pair needs min_cooccur shared baskets or min_sim similarity, and a gap of at least min_gap from the
    easier to the harder end. conf = .35 min(1, cooccur / 3) + .35 sim + .30 min(1, gap / min_gap).
    """
    gap = F.col("db") - F.col("da")
    evident = (F.col("cooccur") >= min_cooccur) | (F.col("sim") >= min_sim)
    up = pairs.filter(evident & (F.abs(gap) >= min_gap))
    # The shares of shared seeds, similarity and difficulty.
    conf = 0.35 * F.least(F.lit(1.0), F.col("cooccur") / 3) + 0.35 * F.col("sim") + 0.30 * F.least(F.lit(1.0), F.abs(gap) / min_gap)
    pick = lambda x, y: F.when(gap > 0, F.col(x)).otherwise(F.col(y))
    return up.select("parent", pick("a", "b").alias("src"), pick("b", "a").alias("dst"), conf.alias("conf"), "cooccur", "sim", F.abs(gap).alias("gap"))


def drop_cycles(edges: DataFrame, group: str) -> DataFrame:
    """Edges (group, src, dst, conf) of a group without cycles: while one is left, its weakest edges go.

    Nodes that no cycle can pass (no edge in, or none out) are peeled off in rounds; of what is left of a
    group, the edge of least (conf, src, dst) goes, and peeling starts again. Edges that climb a strict
    difficulty never need a second round.
    """
    kept = runtime.materialize(edges, "dag")
    while True:
        core = kept.select(group, "src", "dst", "conf")
        size = core.count()
        while size:
            into = core.select(group, F.col("dst").alias("src")).distinct()
            out = core.select(group, F.col("src").alias("dst")).distinct()
            core = runtime.materialize(core.join(into, [group, "src"], "left_semi").join(out, [group, "dst"], "left_semi").select(group, "src", "dst", "conf"), "dag-core")
            left = core.count()
            if left == size:
                break
            size = left
        if not size:
            return kept
        weakest = core.groupBy(group).agg(F.min(F.struct("conf", "src", "dst")).alias("w")).select(group, "w.src", "w.dst")
        kept = runtime.materialize(kept.join(weakest, [group, "src", "dst"], "left_anti"), "dag")


def undirected_anti(candidates: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Candidates whose unordered pair is no edge; loops among the edges are not regarded."""
    named = edges.filter("src <> dst").select(F.least("src", "dst").alias("__a"), F.greatest("src", "dst").alias("__b")).distinct()
    c = candidates.withColumn("__a", F.least(a, b)).withColumn("__b", F.greatest(a, b))
    return c.join(named, ["__a", "__b"], "left_anti").drop("__a", "__b")


def depths(edges: DataFrame, start: DataFrame, hops: int, directed: bool = False, backwards: bool = False) -> DataFrame:
    """node, depth of every node within hops of a start node (start: node)."""
    step = edges.select(F.col("dst").alias("node"), F.col("src").alias("next")) if backwards else edges.select(F.col("src").alias("node"), F.col("dst").alias("next"))
    if not directed:
        step = step.unionByName(step.select(F.col("next").alias("node"), F.col("node").alias("next")))
    step = runtime.materialize(step.distinct(), "bfs-steps")
    seen = runtime.materialize(start.select("node").distinct().withColumn("depth", F.lit(0)), "bfs")
    front = seen
    for d in range(1, hops + 1):
        reached = front.join(step, "node").select(F.col("next").alias("node")).distinct()
        front = runtime.materialize(reached.join(seen, "node", "left_anti").withColumn("depth", F.lit(d)), "bfs-front")
        if front.isEmpty():
            break
        seen = runtime.materialize(seen.unionByName(front), "bfs")
    return seen


def forward_gain(edges: DataFrame, cover: DataFrame, depth: int) -> DataFrame:
    """node, gain: the sum of 1 / (d + 1) / sqrt(1 + cover) over all nodes within depth steps, each at its least d.

    All starts advance together; (start, node) keeps its least distance, so the frame is bounded by the
    pairs within depth steps.
    """
    step = edges.select(F.col("src").alias("node"), F.col("dst").alias("next")).filter("node <> next").distinct()
    nodes = step.select("node").unionByName(step.select(F.col("next").alias("node"))).distinct()
    seen = nodes.select(F.col("node").alias("start"), "node", F.lit(0).alias("d"))
    for d in range(1, depth + 1):
        new = seen.filter(F.col("d") == d - 1).join(step, "node").select("start", F.col("next").alias("node"), F.lit(d).alias("d"))
        seen = runtime.materialize(seen.unionByName(new).groupBy("start", "node").agg(F.min("d").alias("d")), "gain")
    got = seen.join(cover, "node", "left")
    return got.groupBy("start").agg(F.sum(1 / (F.col("d") + 1) / F.sqrt(1 + F.coalesce("cover", F.lit(0)))).alias("gain")).withColumnRenamed("start", "node")


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node")))
    return ends.groupBy("node").agg(F.count("*").alias("degree"))


def homogeneous_merge(nodes: DataFrame, similar: DataFrame) -> DataFrame:
    """old_id, new_id, cluster_size: components of similar nodes (a, b), named after their most frequent node.

    nodes: id, freq, text. Ties go to the longer text, then the smaller id.
    """
    labels = connected_components(similar.select("a", "b")).select(F.col("node").alias("id"), "component")
    placed = nodes.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    best = F.min_by("id", F.struct(-F.coalesce("freq", F.lit(0)), -F.length(F.coalesce("text", F.lit(""))), F.col("id")))
    size = placed.groupBy("component").agg(best.alias("new_id"), F.count("*").alias("cluster_size"))
    return placed.join(size, "component").select(F.col("id").alias("old_id"), "new_id", "cluster_size")


def rewrite_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Edges between merged nodes: loops dropped, parallel ones summed up as max conf, max co-occurrence, min gap."""
    moved = remap(edges, mapping, ["src", "dst"]).filter("src <> dst")
    return moved.groupBy("src", "dst").agg(F.max("conf").alias("conf"), F.max("cooccur").alias("cooccur"), F.min("gap").alias("gap"))


def beam_chains(edges: DataFrame, starts: DataFrame, length: int, beam: int, bridges: int = 3) -> DataFrame:
    """start, chain array, types array, min_conf, rank: the beam left for every start after length - 1 steps.

    edges: src, dst, type (pre, sem or main_sem), conf, cooccur. A chain repeats no node, takes at most one
    main_sem edge, and that only along a node's best bridges. Each step replaces the beam by the best
    of its extensions: number of pre edges, main_sem used, least confidence (descending), mean co-occurrence
    (ascending), then the chain itself. A start without an extension keeps the beam it had.
    """
    main = top_k(edges.filter("type = 'main_sem'"), ["src"], [F.col("conf").desc(), F.col("dst")], bridges).drop("rank")
    steps = runtime.materialize(edges.filter("type <> 'main_sem'").unionByName(main), "beam-edges").select(F.col("src").alias("last"), "dst", "type", F.col("conf").alias("c"), F.col("cooccur").alias("k"))
    now = starts.select(F.col("node").alias("start"), F.array("node").alias("chain"), F.array().cast("array<string>").alias("types"), F.lit(1.0).alias("min_conf"), F.lit(0.0).alias("sum_co"), F.lit(0).alias("pre"), F.lit(0).alias("main"), F.lit(1).alias("rank"))
    now = runtime.materialize(now, "beam")
    for _ in range(length - 1):
        grown = now.withColumn("last", F.element_at("chain", -1)).join(steps, "last").filter(~F.array_contains("chain", F.col("dst")) & ((F.col("main") == 0) | (F.col("type") != "main_sem")))
        grown = grown.select(
            "start", F.array_append("chain", F.col("dst")).alias("chain"), F.array_append("types", F.col("type")).alias("types"), F.least("min_conf", "c").alias("min_conf"), (F.col("sum_co") + F.col("k")).alias("sum_co"),
            (F.col("pre") + (F.col("type") == "pre").cast("int")).alias("pre"), (F.col("main") + (F.col("type") == "main_sem").cast("int")).alias("main"),
        )
        order = [F.col("pre").desc(), F.col("main").desc(), F.col("min_conf").desc(), (F.col("sum_co") / F.size("types")).asc(), F.array_join("chain", ">")]
        best = runtime.materialize(top_k(grown, ["start"], order, beam), "beam")
        stuck = now.join(best.select("start").distinct(), "start", "left_anti")
        now = runtime.materialize(best.unionByName(stuck.select(*best.columns)), "beam")
    return now.filter(F.size("chain") >= 2).select("start", "chain", "types", "min_conf", "rank")


def normalised_entropy(counts: Column) -> Column:
    """Entropy of an array of counts over log(max(2, n))."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    raw = F.aggregate(counts, F.lit(0.0), lambda s, x: s + F.when(x > 0, x * F.log(x.cast("double"))).otherwise(0.0))
    h = F.when(total > 0, F.log(total) - raw / total).otherwise(0.0)
    return h / F.log(F.greatest(F.lit(2), F.size(counts)).cast("double"))




def bridge_score(sim: Column, affinity: Column) -> Column:
    # The shares of words and of subjects.
    return 0.70 * T.clip01(sim) + 0.30 * affinity
