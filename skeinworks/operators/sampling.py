"""Seeded random choice and per-group clustering: repeatable on any number of executors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks import runtime
from skeinworks.operators.relational import top_k


def uniform(seed: int, *columns: str) -> Column:
    """A number in (0, 1) that depends on the seed and the columns only."""
    return (F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def softmax_choice(df: DataFrame, keys: list[str], item: str, score: str, temperature: float, seed: int) -> DataFrame:
    """One item of each group with softmax odds, as the largest of score / t plus Gumbel noise: one aggregate, no cumulative sums."""
    noise = -F.log(-F.log(uniform(seed, *keys, item)))
    return df.groupBy(*keys).agg(F.max_by(item, F.struct(F.col(score) / max(temperature, 1e-3) + noise, F.col(item))).alias(item))


def shuffled_first(df: DataFrame, keys: list[str], item: str, k: int, seed: int) -> DataFrame:
    """k items of each group in a seeded random order."""
    return top_k(df, keys, [F.xxhash64(F.lit(seed), item), F.col(item)], k)


def cluster_groups(df: DataFrame, group: str, item: str, terms: str, weight: str, k: int, fit_rows: int = 80, rounds: int = 10) -> DataFrame:
    """group, item, cluster: k-means on unit tf-idf vectors within each group; groups of at most k items keep each alone.

    Frequencies cover whole groups. Centres are fitted on the fit_rows items of largest weight, all that a task ever holds of a group,
    and every item goes to its nearest centre by joins on terms. Starts are the farthest points in order of weight, so the result
    is the same in every run.
    """
    runtime.ship_package(df.sparkSession)
    rows = df.select(group, item, terms, weight)
    size = rows.groupBy(group).agg(F.count("*").alias("__n"))
    tf = rows.select(group, item, F.explode(terms).alias("__t")).groupBy(group, item, "__t").agg(F.count("*").alias("__f"))
    idf = tf.groupBy(group, "__t").agg(F.count("*").alias("__d"))
    v = tf.join(idf, [group, "__t"]).join(size, group).withColumn("__v", F.col("__f") * (F.log((1 + F.col("__n")) / (1 + F.col("__d"))) + 1))
    norm = v.groupBy(group, item).agg(F.greatest(F.sqrt(F.sum(F.col("__v") * F.col("__v"))), F.lit(1e-12)).alias("__norm"))
    unit = runtime.materialize(v.join(norm, [group, item]).select(group, item, "__t", (F.col("__v") / F.col("__norm")).alias("__v")), "cluster-units")
    first = top_k(rows.select(group, item, weight), [group], [F.col(weight).desc(), F.col(item)], max(fit_rows, k), "__place").join(size, group)
    alone = first.filter(F.col("__n") <= k).select(group, item, (F.col("__place") - 1).cast("int").alias("cluster"))
    fitted = first.filter((F.col("__n") > k) & (F.col("__place") <= fit_rows)).join(unit, [group, item], "left").select(group, "__place", "__t", "__v")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        words = sorted(pdf["__t"].dropna().unique())
        column, order = {t: i for i, t in enumerate(words)}, {p: i for i, p in enumerate(sorted(pdf["__place"].unique()))}
        x = np.zeros((len(order), max(1, len(words))))
        known = pdf.dropna(subset=["__t"])
        x[known["__place"].map(order).to_numpy(int), known["__t"].map(column).to_numpy(int)] = known["__v"]
        chosen = [0]
        for _ in range(k - 1):
            chosen.append(int((1 - x @ x[chosen].T).min(axis=1).argmax()))
        centre = x[chosen]
        for _ in range(rounds):
            near = (x @ centre.T - (centre**2).sum(axis=1) / 2).argmax(axis=1)
            new = np.stack([x[near == j].mean(axis=0) if (near == j).any() else centre[j] for j in range(k)])
            if np.allclose(new, centre):
                break
            centre = new
        at, word = np.nonzero(centre)
        half = (centre**2).sum(axis=1) / 2
        out = pd.DataFrame({"cluster": np.r_[np.arange(k), at].astype(np.int32), "__t": [None] * k + [words[i] for i in word], "__c": np.r_[half, centre[at, word]]})
        out.insert(0, group, pdf[group].iloc[0])
        return out

    kind = df.schema[group].dataType.simpleString()
    centres = runtime.materialize(fitted.groupBy(group).applyInPandas(fit, f"{group} {kind}, cluster int, __t string, __c double"), "cluster-centres")
    half = centres.filter("__t is null").select(group, "cluster", F.col("__c").alias("__half"))
    dots = unit.join(centres.filter("__t is not null"), [group, "__t"]).groupBy(group, item, "cluster").agg(F.sum(F.col("__v") * F.col("__c")).alias("__dot"))
    every = rows.select(group, item).join(half, group).join(dots, [group, item, "cluster"], "left").withColumn("__s", F.round(F.coalesce("__dot", F.lit(0.0)) - F.col("__half"), 12))
    near = every.groupBy(group, item).agg(F.max_by("cluster", F.struct("__s", -F.col("cluster"))).alias("cluster"))
    return near.unionByName(alone)


def feedback_picks(chains: DataFrame, rounds: int, recent: int = 64) -> list[tuple]:
    """(round, id, score): each round's best chain, given what the rounds before it took.

    chains: id, nodes array<string> (distinct). A chain's score is the sum over its nodes of 1 / sqrt(1 + how often the node was taken); ties go to
    the smaller id, and the last recent chains are not taken again. The state that is carried on holds the nodes of the
    chains taken so far, a few for each round; every round is one pass over the chains.
    """
    taken: dict[str, int] = {}
    out: list[tuple] = []
    for r in range(1, rounds + 1):
        counts = F.create_map(*(F.lit(x) for kv in sorted(taken.items()) for x in kv)) if taken else None
        of = lambda n: F.coalesce(F.try_element_at(counts, n), F.lit(0)) if counts is not None else F.lit(0)  # noqa: B023, E731
        score = F.round(F.aggregate("nodes", F.lit(0.0), lambda s, n: s + 1 / F.sqrt(1.0 + of(n))), 9)
        last = [x[1] for x in out[-recent:]] if recent else []
        left = chains.filter(~F.col("id").isin(last)) if last else chains
        best = left.filter(F.size("nodes") > 0).agg(F.min_by(F.struct("id", "nodes", score.alias("score")), F.struct(-score, F.col("id"))).alias("b")).first()[0]
        if best is None:
            break
        out.append((r, best["id"], best["score"]))
        for n in best["nodes"]:
            taken[n] = taken.get(n, 0) + 1
    return out


COUNTS = {"easy": 1, "medium": 2, "hard": 3}


def rotated(seeds: list[str], targets: dict[str, str], slots: list[tuple[str, list[str]]], nodes: list[str]) -> list[list[str]]:
    """The seeds of each slot (difficulty, backbone): the next unused one of the batch, then those aimed at its backbone and other nodes, then any."""
    out, cursor = [], 0
    for difficulty, backbone in slots:
        want, chosen = COUNTS.get(difficulty, 3), []
        if cursor < len(seeds):
            chosen.append(seeds[cursor])
            cursor += 1
        places = {n: k for k, n in enumerate(dict.fromkeys([*backbone, *nodes]))}
        rest = [q for q in dict.fromkeys(seeds) if q not in chosen]
        rest.sort(key=lambda q: places.get(targets.get(q), len(places)))  # stable: the plan's order within a node
        # One that needs no second keeps the first even where more could follow.
        out.append(chosen + rest[: max(0, want - len(chosen))])
    return out


def rotate_seeds(batches: DataFrame) -> DataFrame:
    """id, slot_id, seeds: seeds dealt fairly over the slots of each batch, within its row.

    batches: id bigint, seeds, seed_nodes, nodes array<string>, slots array<struct<difficulty, backbone array<string>>>.
    Null arrays count as empty; repeated seeds count once for choices.
    """
    runtime.ship_package(batches.sparkSession)

    def run(frames):
        for pdf in frames:
            rows = []
            for i, seeds, aims, nodes, slots in zip(pdf["id"], pdf["seeds"], pdf["seed_nodes"], pdf["nodes"], pdf["slots"]):
                own = [] if seeds is None else list(seeds)
                plan = [(s["difficulty"], list(s["backbone"]) if s["backbone"] is not None else []) for s in ([] if slots is None else slots)]
                got = rotated(own, dict(zip(own, [] if aims is None else aims)), plan, [] if nodes is None else list(nodes))
                rows += [(i, k + 1, x) for k, x in enumerate(got)]
            yield pd.DataFrame(rows, columns=["id", "slot_id", "seeds"])

    return batches.select("id", "seeds", "seed_nodes", "nodes", "slots").mapInPandas(run, "id long, slot_id int, seeds array<string>")
