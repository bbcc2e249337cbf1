"""Items that appear together: heavy-light decomposition of pair counts, and lift.

Items in at least a HEAVY_SHARE of all records are heavy, at most the MAX_HEAVY most frequent of them (a task holds
8 MB of counts and 16 MB of bits for those; the others are counted as light ones). Pairs of heavy items are counted by popcounts over bit rows of blocks of
records, pairs of light items by sorted partial counts of the pairs each record holds, and mixed pairs
by probing each light occurrence's record in the heavy bit rows. Every task sums its own counts before
anything is shuffled; the three kinds of count are added up and lift is scored.

Items are coded by 64-bit hashes; if two items that matter share a code, all are coded anew with another salt.
Items below min_count are dropped before any pairing, which loses no pair that reaches min_count.

Defined results: null records, null and blank items are ignored; an item counts once in a record, and
rows that repeat a record are merged into it; an empty table gives an empty frame; extra columns are
ignored; long lists are paired shift by shift, so memory grows with a list's length and not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinworks import runtime

HEAVY_SHARE = 1 / 64
MAX_HEAVY = 1024
BLOCK = 1 << 14
BUFFER = 1 << 21
DICTIONARY_ROWS = 200_000
SPACE = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


class _Pairs:
    """Partial counts of pairs of codes, summed whenever the buffer is full."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, a: np.ndarray, b: np.ndarray, k: np.ndarray | None = None) -> None:
        if len(a):
            self.parts.append((np.minimum(a, b), np.maximum(a, b), np.ones(len(a), np.int64) if k is None else k))
            self.held += len(a)

    def sum(self) -> None:
        if self.parts:
            a, b, k = (np.concatenate(x) for x in zip(*self.parts))
            order = np.lexsort((b, a))
            a, b, k = a[order], b[order], k[order]
            first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            self.parts = [(a[first], b[first], np.add.reduceat(k, first))]
            self.held = len(first)

    def full(self) -> bool:
        if self.held > BUFFER:
            self.sum()
        return self.held > BUFFER // 2

    def flush(self) -> Iterator[pa.RecordBatch]:
        self.sum()
        for a, b, k in self.parts:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(k)], names=["a", "b", "k"])
        self.parts, self.held = [], 0


def _count_pairs(heavy: np.ndarray):
    """heavy: sorted codes of the heavy items."""
    size = len(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, pairs = np.zeros((size, size), np.int64), _Pairs()
        for batch in batches:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            codes = lists.values.to_numpy(zero_copy_only=False)
            for lo in range(0, len(offsets) - 1, BLOCK):
                ends = offsets[lo : lo + BLOCK + 1]
                c = codes[ends[0] : ends[-1]]
                rec = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                at = np.searchsorted(heavy, c)
                big = (at < size) & (heavy[np.minimum(at, size - 1)] == c) if size else np.zeros(len(c), bool)
                light, light_rec = c[~big], rec[~big]
                if size:
                    bits = np.zeros((size, len(ends) - 1), bool)
                    bits[at[big], rec[big]] = True
                    _popcounts(bits, dense)
                    step = max(1, BUFFER // size)
                    for s in range(0, len(light), step):  # probe the lists of light items
                        h, occurrence = np.nonzero(bits[:, light_rec[s : s + step]])
                        pairs.add(heavy[h], light[s : s + step][occurrence])
                        if pairs.full():
                            yield from pairs.flush()
                # Light items of one record lie side by side; shift s pairs each with its s-th successor.
                at_, s = np.arange(len(light)), 1
                while True:
                    at_ = at_[at_ + s < len(light)]
                    at_ = at_[light_rec[at_] == light_rec[at_ + s]]
                    if not len(at_):
                        break
                    pairs.add(light[at_], light[at_ + s])
                    if pairs.full():
                        yield from pairs.flush()
                    s += 1
        i, j = np.nonzero(np.triu(dense, 1))
        pairs.add(heavy[i], heavy[j], dense[i, j])
        yield from pairs.flush()

    return run


def _popcounts(bits: np.ndarray, dense: np.ndarray) -> None:
    """Add to dense[i, j], i < j, in how many columns rows i and j are both set."""
    packed = np.packbits(bits, axis=1)
    words = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
    words[:, : packed.shape[1]] = packed
    words = words.view(np.uint64)
    for i in range(len(words) - 1):
        dense[i, i + 1 :] += np.bitwise_count(words[i] & words[i + 1 :]).sum(axis=1, dtype=np.int64)


def cooccurrence(baskets: DataFrame, min_count: int, min_permyriad: int = 0, heavy_share: float = HEAVY_SHARE, dictionary_rows: int = DICTIONARY_ROWS, max_heavy: int = MAX_HEAVY, code=None) -> DataFrame:
    """item_a < item_b, together, records_a, records_b, records, lift of all pairs that share enough records.

    baskets: record (any type), items array<string>, already normalised. A pair is kept if it shares at
    least min_count records and min_permyriad / 10000 of all records. code: the hash of an item's column under a salt.
    """
    code = code or (lambda c, salt: F.xxhash64(c) if not salt else F.xxhash64(F.lit(salt), c))
    spark = baskets.sparkSession
    runtime.ship_package(spark)
    single = baskets.filter("record is not null").select("record", F.explode("items").alias("item")).filter("item is not null and item <> ''")
    salt = 0
    while True:
        coded = single.withColumn("code", code("item", salt))
        names = coded.groupBy("code").agg(F.min("item").alias("item"), F.max("item").alias("other"))
        lists = runtime.materialize(coded.groupBy("record").agg(F.sort_array(F.collect_set("code")).alias("codes")).select("codes"), "baskets")
        records = lists.count()
        least = max(1, min_count, -(-records * min_permyriad // 10000))
        counts = lists.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
        items = runtime.materialize(counts.join(names, "code"), "basket-items")
        if items.filter("item <> other").isEmpty():
            break
        runtime.drop_materialized(lists, items)
        salt += 1
    kept = items.count()
    often = items.filter(F.col("n") >= max(1.0, heavy_share * records)).orderBy(F.desc("n"), "code").limit(max_heavy)
    heavy = sorted(r[0] for r in often.select("code").collect())
    if kept <= dictionary_rows:
        codes = spark.sparkContext.broadcast(np.array(sorted(r[0] for r in items.select("code").collect()), np.int64))
        pruned = lists.mapInArrow(_keep_codes(codes), "codes array<long>")
    else:
        numbered = lists.withColumn("row", F.monotonically_increasing_id()).select("row", F.explode("codes").alias("code"))
        pruned = numbered.join(items.select("code"), "code").groupBy("row").agg(F.collect_list("code").alias("codes")).select("codes")
    partial = pruned.filter(F.size("codes") > 1).mapInArrow(_count_pairs(np.array(heavy, np.int64)), "a long, b long, k long")
    total = partial.groupBy("a", "b").agg(F.sum("k").alias("together")).filter(F.col("together") >= least)
    side = lambda x: runtime.bounded_broadcast(items.select(F.col("code").alias(x), F.col("item").alias(f"item_{x}"), F.col("n").alias(f"n_{x}")), kept, dictionary_rows)
    named = total.join(side("a"), "a").join(side("b"), "b")
    swap = F.col("item_a") > F.col("item_b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return named.select(
        pick("item_a", "item_b").alias("item_a"), pick("item_b", "item_a").alias("item_b"), "together",
        pick("n_a", "n_b").alias("records_a"), pick("n_b", "n_a").alias("records_b"), F.lit(records).cast("long").alias("records"),
        (F.col("together") * F.lit(float(records)) / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"),
    )


def _keep_codes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = shared.value
        for b in batches:
            lists = b.column(0)
            offsets, codes = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
            at = np.searchsorted(good, codes)
            ok = (at < len(good)) & (good[np.minimum(at, max(0, len(good) - 1))] == codes) if len(good) else np.zeros(len(codes), bool)
            kept = np.r_[0, np.cumsum(ok)][offsets]
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), pa.array(codes[ok[: len(codes)]]))], names=["codes"])

    return run


def field_baskets(spark, sf_dir: str) -> dict[str, DataFrame]:
    """The two fields of the test tables as records of normalised items."""
    chains = runtime.table(spark, sf_dir, "synth_refill").select(F.col("synth_id").alias("record"), F.transform("chain_subnodes", trimmed).alias("items"))
    clean = lambda c: trimmed(F.regexp_replace(F.lower(c), f"{SPACE}+", " "))
    concepts = runtime.table(spark, sf_dir, "audit_relevance").select(F.col("qid").alias("record"), F.transform(F.split("concepts", "[|;]"), clean).alias("items"))
    return {"chain_subnodes": chains, "concepts": concepts}


def _on_tables(spark, sf_dir: str) -> DataFrame:
    # k * 2000 >= N is a share of 5 in 10000.
    one, two = (cooccurrence(b, 5, 5).withColumn("field", F.lit(f)) for f, b in field_baskets(spark, sf_dir).items())
    exact = lambda c: F.col(c).cast("decimal(18,0)")
    return one.unionByName(two).filter(exact("together") * exact("records") >= exact("records_a") * exact("records_b") * 3)


def p5_found(spark, sf_dir: str) -> DataFrame:
    return _on_tables(spark, sf_dir).select("field", "item_a", "item_b")


def p5_lift(spark, sf_dir: str) -> DataFrame:
    """The same pairs with their counts and lift (rounded to nine digits)."""
    return _on_tables(spark, sf_dir).select("field", "item_a", "item_b", "together", "records_a", "records_b", "records", F.round("lift", 9).alias("lift"))


_SQL = r"""
WITH o AS (
  SELECT DISTINCT 'chain_subnodes' AS field, CAST(synth_id AS VARCHAR) AS rec, regexp_replace(x, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS item
  FROM (SELECT synth_id, unnest(chain_subnodes) AS x FROM synth_refill)
  UNION ALL
  SELECT DISTINCT 'concepts', qid, regexp_replace(regexp_replace(lower(x), '[\s\p{Z}]+', ' ', 'g'), '^ | $', '', 'g')
  FROM (SELECT qid, unnest(regexp_split_to_array(concepts, '[|;]')) AS x FROM audit_relevance)),
s AS (SELECT * FROM o WHERE rec IS NOT NULL AND item <> ''),
n AS (SELECT field, count(DISTINCT rec) AS records FROM s GROUP BY field),
c AS (SELECT field, item, count(*) AS k FROM s GROUP BY field, item),
p AS (SELECT a.field, a.item AS item_a, b.item AS item_b, count(*) AS together FROM s a JOIN s b ON a.field = b.field AND a.rec = b.rec AND a.item < b.item GROUP BY ALL),
r AS (SELECT p.field, item_a, item_b, together, ca.k AS records_a, cb.k AS records_b, records, round(together * records / (ca.k * cb.k::DOUBLE), 9) AS lift
  FROM p JOIN n USING (field) JOIN c ca ON ca.field = p.field AND ca.item = item_a JOIN c cb ON cb.field = p.field AND cb.item = item_b
  WHERE together >= 5 AND together * 2000 >= records AND together * records >= 3 * ca.k * cb.k)
"""
P5_SQL = _SQL + "SELECT field, item_a, item_b FROM r"
P5_LIFT_SQL = _SQL + "SELECT * FROM r"
