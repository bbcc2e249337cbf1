"""Joins, ranks, ids and allocations that recur in graph building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinworks import runtime


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group in a total order; Catalyst turns the filter into a per-partition group limit."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, with all its columns."""
    return top_k(df, keys, order, 1, "__place").drop("__place")


def check_rate(hits: int, rows: int, most: float, what: str = "changes") -> float:
    """The share of hits; an error if it is above most. No rows give 0."""
    rate = hits / rows if rows else 0.0
    if rate > most:
        raise ValueError(f"{what}: {hits} of {rows} rows is more than {most:.0%}")
    return rate


def dense_id(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Positions 0, 1, 2, ... in the order of the given columns, without sorting everything in one task.

    Rows are range-partitioned and sorted; the sizes of the partitions (one number each) give every
    partition its offset. The order must be total for repeatable positions.
    """
    spark = df.sparkSession
    runtime.ship_package(spark)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    placed = runtime.materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), "dense")
    # Low bits of the id count within a partition, so the least one of a partition is its first row.
    first = placed.groupBy("__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    offset = first.withColumn("__offset", F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    out = placed.join(F.broadcast(offset.select("__part", "__first", F.coalesce("__offset", F.lit(0)).alias("__offset"))), "__part")
    return out.withColumn(name, F.col("__at") - F.col("__first") + F.col("__offset")).drop("__part", "__at", "__first", "__offset")


def mode_first(df: DataFrame, keys: list[str], value: str, skip_blank: bool = True) -> DataFrame:
    """The most frequent value of each group; ties go to the smaller one."""
    rows = df.filter(F.col(value).isNotNull())
    if skip_blank:
        rows = rows.filter(~F.trim(value).isin("", "nan"))
    counted = rows.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    return counted.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(value))


def pairs_within(df: DataFrame, parent: str, item: str) -> DataFrame:
    """parent, a, b for every two items of a parent, a < b."""
    left = df.select(parent, F.col(item).alias("a")).distinct()
    right = df.select(parent, F.col(item).alias("b")).distinct()
    return left.join(right, parent).filter("a < b")


def cooccurrence_counts(pairs: DataFrame, index: DataFrame, item: str, basket: str) -> DataFrame:
    """pairs (with a, b) and the number of baskets that hold both, 0 included.

    Only items named in a pair and only pairs named are counted: the index is joined with the pairs on one
    side first, so no basket is multiplied out.
    """
    once = index.select(F.col(item).alias("__i"), F.col(basket).alias("__b")).distinct()
    named = pairs.select("a", "b").distinct()
    left = named.join(once, named["a"] == once["__i"]).select("a", "b", "__b")
    both = left.join(once.select(F.col("__i").alias("b"), "__b"), ["b", "__b"])
    counted = both.groupBy("a", "b").agg(F.count("*").alias("cooccur"))
    return pairs.join(counted, ["a", "b"], "left").withColumn("cooccur", F.coalesce("cooccur", F.lit(0)).cast("long"))


def largest_remainder(df: DataFrame, keys: list[str], total: str, share: str, priority: str) -> DataFrame:
    """allocated: whole parts of total by share within a group, the rest to the largest fractions (then priority)."""
    exact = F.greatest(F.col(total), F.lit(1)) * F.col(share)
    base = F.floor(exact + 1e-9)
    rows = df.withColumn("__base", base).withColumn("__frac", exact - base)
    group = Window.partitionBy(*keys)
    left = F.greatest(F.max(total).over(group), F.lit(1)) - F.sum("__base").over(group)
    rank = F.row_number().over(group.orderBy(F.round("__frac", 9).desc(), F.col(priority).desc()))
    out = rows.withColumn("__left", left).withColumn("__rank", rank)
    return out.withColumn("allocated", (F.col("__base") + (F.col("__rank") <= F.col("__left")).cast("int")).cast("int")).drop("__base", "__frac", "__left", "__rank")


def degree_capped(edges: DataFrame, cap: int, order: list[Column]) -> DataFrame:
    """Edges (src, dst) that a greedy scan in a total order takes while both ends have less than cap.

    An edge within the free capacity of both its ends, by rank among the edges left, is taken by the greedy
    scan whatever comes later; taking all of these at a time gives the same edges in a few rounds.
    """
    left = runtime.materialize(edges.withColumn("__order", F.struct(*order)), "capped")
    done = None
    while True:
        used = done.select(F.col("src").alias("node")).unionByName(done.select(F.col("dst").alias("node"))).groupBy("node").agg(F.count("*").alias("used")) if done is not None else None
        rows = left
        for end in ("src", "dst"):
            if used is not None:
                rows = rows.join(used.select(F.col("node").alias(end), F.col("used").alias(f"__{end}")), end, "left").withColumn(f"__{end}", F.coalesce(f"__{end}", F.lit(0)))
            else:
                rows = rows.withColumn(f"__{end}", F.lit(0))
        rows = rows.filter((F.col("__src") < cap) & (F.col("__dst") < cap))
        ends = rows.select(F.col("src").alias("node"), "src", "dst", "__order", (cap - F.col("__src")).alias("free")).unionByName(rows.select(F.col("dst").alias("node"), "src", "dst", "__order", (cap - F.col("__dst")).alias("free")))
        ranked = ends.withColumn("__rank", F.row_number().over(Window.partitionBy("node").orderBy("__order"))).filter("__rank <= free")
        taken = runtime.materialize(ranked.groupBy("src", "dst").agg(F.count("*").alias("n")).filter("n = 2").join(rows, ["src", "dst"]).select(*edges.columns), "capped-taken")
        if taken.isEmpty():
            break
        done = taken if done is None else runtime.materialize(done.unionByName(taken), "capped-done")
        left = runtime.materialize(rows.join(taken.select("src", "dst"), ["src", "dst"], "left_anti").select(*edges.columns, "__order"), "capped-left")
    return done if done is not None else edges.limit(0)


def remap(df: DataFrame, mapping: DataFrame, columns: list[str], old: str = "old_id", new: str = "new_id") -> DataFrame:
    """Each column's ids replaced by their new id where the mapping has one."""
    for c in columns:
        m = mapping.select(F.col(old).alias(c), F.col(new).alias("__new"))
        df = df.join(m, c, "left").withColumn(c, F.coalesce("__new", c)).drop("__new")
    return df


def conform(df: DataFrame, schema, defaults: dict | None = None) -> DataFrame:
    """Exactly the schema's columns: absent ones by default, others cast; what cannot be cast is the default."""
    defaults = defaults or {}
    out = []
    for f in schema.fields:
        default = F.lit(defaults.get(f.name)).cast(f.dataType)
        if f.name not in df.columns:
            out.append(default.alias(f.name))
        else:
            got = F.col(f.name)
            cast = got if df.schema[f.name].dataType == f.dataType else got.try_cast(f.dataType)
            out.append(F.coalesce(cast, default).alias(f.name))
    return df.select(*out)
