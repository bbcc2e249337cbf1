"""Connected components of an edge table, without a driver-side graph.

Each round contracts the edges of every partition to stars in numpy, at most EDGES at a time. A node then points to the least root it got anywhere; the roots of one node are linked to each other,
roots that point on elsewhere keep that link (two pointers deep), and the next round has only those
links, between roots. The largest node of a round is never a root, so rounds end, usually after two or
three. The rounds' pointers are then followed backwards. Lineage is cut by tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks import runtime


EDGES = 1 << 21


def _contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node but the roots, and the least node it is linked to, by hooking roots to smaller ones and halving paths."""
    nodes, codes = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = codes[: len(u)], codes[len(u) :]
    parent = np.arange(len(nodes))
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    low = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[low], nodes[parent[low]]


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of a partition's edges, contracted in numpy whenever EDGES are held; loops of nodes without another edge."""
    kind, held, size = None, [], 0
    alone: list[np.ndarray] = []

    def contract() -> None:
        nonlocal held, size
        u, v = (np.concatenate(x) for x in zip(*held))
        loop = u == v
        if loop.any():
            alone.append(np.unique(u[loop]))
            u, v = u[~loop], v[~loop]
        u, v = _contract(u, v) if len(u) else (u, v)
        held, size = [(u, v)], len(u)

    for b in batches:
        kind = b.schema.field(0).type
        held.append(tuple(c.to_numpy(zero_copy_only=False) for c in b.columns[:2]))
        size += b.num_rows
        if size > EDGES:
            contract()
            if size > EDGES // 2:  # mostly stars of their own: hand them on and begin anew
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x in held[0]], names=["u", "v"])
                held, size = [], 0
    if held:
        contract()
        u, v = held[0]
        yield pa.RecordBatch.from_arrays([pa.array(u, kind), pa.array(v, kind)], names=["u", "v"])
    if alone:
        lone = np.unique(np.concatenate(alone))
        yield pa.RecordBatch.from_arrays([pa.array(lone, kind), pa.array(lone, kind)], names=["u", "v"])


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node it is linked to) for every end of an edge.

    edges: two columns of one orderable type. Edges with a null end are ignored; loops make a component of
    one node; repeated edges and either direction count the same; an empty table gives an empty frame.
    """
    runtime.ship_package(edges.sparkSession)
    u, v = edges.columns[:2]
    kind = edges.schema[u].dataType.simpleString()
    ends = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u is not null and v is not null")
    now, pointers, loops, kept = ends, [], None, []
    while True:
        stars = runtime.materialize(now.mapInArrow(_local_stars, f"u {kind}, v {kind}"), "stars")
        loops = stars.filter("u = v").select(F.col("u").alias("node")).distinct() if loops is None else loops
        local = stars.filter("u <> v")
        least = runtime.materialize(local.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most")), "pointers")
        pointers.append(least)
        # Only nodes with two roots, and roots that point on, take part in the next round.
        split = local.join(least.filter("m < most").select("u", "m"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        onward = least.select("u", "m").join(local.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        jump = onward.join(least.select(F.col("u").alias("m"), F.col("m").alias("next")), "m", "left").select("u", F.coalesce("next", "m").alias("v"))
        now = runtime.materialize(split.unionByName(jump).distinct(), "links")
        if len(pointers) > 1:
            runtime.drop_materialized(stars, *kept[1:])
            kept = kept[:1]
        kept.append(stars if len(pointers) == 1 else now)
        if now.isEmpty():
            break
    labels = None
    for least in reversed(pointers):
        here = least.select(F.col("u").alias("node"), F.col("m").alias("component"))
        if labels is not None:
            above = labels.select(F.col("node").alias("component"), F.col("component").alias("top"))
            here = here.join(above, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
            labels = here.unionByName(labels).distinct()
        else:
            labels = here
    roots = labels.select(F.col("component").alias("node")).distinct().withColumn("component", F.col("node"))
    out = labels.unionByName(roots)
    lone = loops.join(out.select("node"), "node", "left_anti").withColumn("component", F.col("node"))
    return runtime.keep_with(out.unionByName(lone), *pointers, *kept)
