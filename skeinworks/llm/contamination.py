"""Held-out texts inside a corpus, by winnowed word-run fingerprints.

Of every window of WINDOW consecutive RUN-word hashes the smallest is kept. A span of
RUN + WINDOW - 1 = 13 shared words has a whole window in common, so both sides keep the same
fingerprint in it; each common fingerprint is then extended word by word to both sides, and counts only
if the shared run reaches 13 words. Nothing shorter passes and nothing of that length is missed.

Equal fingerprints that follow each other at one gap, as in repetitive text, are met by diagonals, so a text of equal words
takes work by its length. The fingerprints of the held-out items are broadcast, about 100 bytes a word, in blocks of about ITEM_WORDS
words: larger sets take one pass over the corpus for each block. Neither a document nor a fingerprint is ever shuffled, so
common phrases make no hot key.

Defined results: rows with a null id or text give none; repeated rows give one; texts of fewer than 13
words give none; empty tables give an empty frame; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks import runtime
from skeinworks.llm import textops as tx

SPAN = 13
RUN = 7
ITEM_WORDS = 500_000
RESULT = "doc_id long, item_id long, words_shared int"


def fingerprints(h: np.ndarray, offsets: np.ndarray, run: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes kept by winnowing; texts of fewer than run words keep none."""
    grams = tx.run_hashes(h, run)
    if not len(grams):
        return np.zeros(0, np.int64), grams
    own = tx.owners(offsets)
    inside = own[: len(grams)] == own[run - 1 :]
    grams = np.where(inside, grams, np.uint64(2**64 - 1))
    if len(grams) <= window:
        keep = np.flatnonzero(inside)
    else:
        # A window over a bound between texts may keep one fingerprint more, never one less.
        low = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1].argmin(axis=1)
        keep = np.unique(np.arange(len(low)) + window - 1 - low)
        keep = keep[inside[keep]]
        # Texts too short for a whole window of their own keep their smallest all the same, by the windows that cover them.
    return keep, grams[keep]


def _framed(h: np.ndarray, offsets: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """The words with a mark before each text and at the end, and each word's place there."""
    n = len(offsets) - 1
    out = np.full(len(h) + n + 1, mark, np.uint64)
    place = np.arange(len(h)) + tx.owners(offsets) + 1
    out[place] = h
    return out, place


def _chains(pos: np.ndarray, fp: np.ndarray, own: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of one fingerprint that follow each other in a text at one gap of at most run words, as in repetitive text.

    For each chain: the number of its first place, its places, and the gap (0 for a lone place). The words between two places of a
    chain are all covered by its runs, so a shared run that holds one of them on some diagonal holds the others as well.
    """
    order = np.lexsort((pos, fp, own))
    p, f, o = pos[order], fp[order], own[order]
    near = (f[1:] == f[:-1]) & (o[1:] == o[:-1]) & (p[1:] - p[:-1] <= run)
    step = np.where(near, p[1:] - p[:-1], 0)
    before = np.r_[0, step[:-1]] if len(step) else step
    new = np.r_[True, (step == 0) | (step != before) & (before > 0)][: len(p)]
    start = np.flatnonzero(new)
    count = np.diff(np.r_[start, len(p)])
    gap = np.where(count > 1, np.r_[step, 0][start] if len(p) else 0, 0)
    return order[start], count, gap


class ItemIndex:
    """Chains of equal fingerprints of the held-out items in sorted order, with their places."""

    def __init__(self, ids: list[int], texts: list[str | None], span: int = SPAN, run: int = RUN):
        self.ids, self.span, self.run, self.window = np.array(ids, np.int64), span, run, span - run + 1
        h, offsets = tx.hash_word_lists(tx.word_lists(texts))
        pos, fp = fingerprints(h, offsets, run, self.window)
        own = tx.owners(offsets)
        self.fp = np.unique(fp)
        self.words, place = _framed(h, offsets, 0)
        head, self.chain_n, self.chain_gap = _chains(pos, fp, own[pos], run)
        order = np.argsort(fp[head], kind="stable")
        head, self.chain_n, self.chain_gap = head[order], self.chain_n[order], self.chain_gap[order]
        self.chain_fp, self.chain_at, self.chain_item = fp[head], place[pos[head]], own[pos[head]]

    def hits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, item number and length of every shared run of at least span words."""
        none = np.zeros(0, np.int64)
        h, offsets = tx.hash_word_lists(tx.word_lists(texts))
        pos, fp = fingerprints(h, offsets, self.run, self.window)
        known = np.isin(fp, self.fp)
        pos, fp = pos[known], fp[known]
        if not len(pos):
            return none, none, none
        words, place = _framed(h, offsets, 1)
        own = tx.owners(offsets)
        head, count, gap = _chains(pos, fp, own[pos], self.run)
        p, n, d = pos[head], count, gap
        lo, hi = np.searchsorted(self.chain_fp, fp[head], "left"), np.searchsorted(self.chain_fp, fp[head], "right")
        pairs = hi - lo
        a = np.repeat(np.arange(len(head)), pairs)
        b = np.arange(len(a)) - np.repeat(np.cumsum(pairs) - pairs, pairs) + np.repeat(lo, pairs)
        m, k = n[a], self.chain_n[b]
        # Two chains of one gap lie on m + k - 1 diagonals; one place of each is enough, as a chain has no hole.
        same = (m > 1) & (k > 1) & (d[a] == self.chain_gap[b])
        total = np.where(same, m + k - 1, m * k)
        which = np.repeat(np.arange(len(a)), total)
        t = np.arange(len(which)) - np.repeat(np.cumsum(total) - total, total)
        kk, ss = k[which], same[which]
        i = np.where(ss, np.maximum(0, t - (kk - 1)), t // kk)
        j = np.where(ss, np.maximum(0, kk - 1 - t), t % kk)
        at = p[a[which]] + i * d[a[which]]
        left0 = place[at]
        right0 = self.chain_at[b[which]] + j * self.chain_gap[b[which]]
        total = self._extend(words, left0 - 1, right0 - 1, -1) + self._extend(words, left0, right0, 1)
        ok = total >= self.span
        return own[at[ok]], self.chain_item[b[which]][ok], total[ok]

    def _extend(self, words: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many words agree from places a and b on; the marks differ, so texts' ends stop it."""
        n, alive, a, b = np.zeros(len(a), np.int64), np.arange(len(a)), a.copy(), b.copy()
        while len(alive):
            alive = alive[words[a[alive]] == self.words[b[alive]]]
            n[alive] += 1
            a[alive] += step
            b[alive] += step
        return n


def _rows(ids: list[int], items: np.ndarray, hit: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    best: dict[tuple[int, int], int] = {}
    for d, i, n in zip(*(x.tolist() for x in hit)):
        key = (ids[d], int(items[i]))
        best[key] = max(best.get(key, 0), n)
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in best], pa.int64()), pa.array([k[1] for k in best], pa.int64()), pa.array(list(best.values()), pa.int32())], names=["doc_id", "item_id", "words_shared"])


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(*shared.value)
        for b in batches:
            ids = b.column(0).to_pylist()
            yield _rows(ids, index.ids, index.hits(b.column(1).to_pylist()))

    return run


def contaminated(documents: DataFrame, items: DataFrame, span: int = SPAN, run: int = RUN, item_words: int = ITEM_WORDS) -> DataFrame:
    """doc_id, item_id, words_shared (the longest run) of every document that shares span words in a row with an item.

    documents: doc_id bigint, text string. items: item_id bigint, text string.
    """
    if not 0 < run <= span:
        raise ValueError("run must lie between 1 and span")
    spark = documents.sparkSession
    runtime.ship_package(spark)
    docs = documents.select("doc_id", "text").filter("doc_id is not null and text is not null")
    held = items.select("item_id", "text").filter("item_id is not null and text is not null")
    rows, words = held.agg(F.count("*"), F.sum(F.length("text") / 2 + 1)).first()  # at most so many words
    blocks = max(1, min(rows, ceil((words or 0) / max(1, item_words))))
    found = None
    for k in range(blocks):
        block = held if blocks == 1 else held.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        own = block.collect()  # one block
        shared = spark.sparkContext.broadcast(([r[0] for r in own], [r[1] for r in own], span, run))
        hits = docs.mapInArrow(_scan(shared), RESULT)
        if blocks == 1:
            found = hits
        else:
            found = runtime.append(hits, found, "leaks")
            shared.unpersist()
    return found.groupBy("doc_id", "item_id").agg(F.max("words_shared").alias("words_shared"))


def _on_tables(spark, sf_dir: str) -> DataFrame:
    return contaminated(runtime.table(spark, sf_dir, "documents"), runtime.table(spark, sf_dir, "eval_items"))


def p6_found(spark, sf_dir: str) -> DataFrame:
    return _on_tables(spark, sf_dir).select("doc_id", "item_id")


def p6_leaked_items(spark, sf_dir: str) -> DataFrame:
    """Every held-out item with the number of documents that hold it and the longest span found."""
    items = runtime.table(spark, sf_dir, "eval_items").select("item_id", "suite")
    per = _on_tables(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words_shared").alias("longest_span"))
    return items.join(per, "item_id", "left").select("item_id", "suite", F.coalesce("documents", F.lit(0)).cast("long").alias("documents"), F.coalesce("longest_span", F.lit(0)).cast("int").alias("longest_span"))


P6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w FROM eval_items WHERE text IS NOT NULL),
dg AS (SELECT doc_id, hash(w[p:p + 12]) h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) p FROM d WHERE len(w) >= 13)),
ig AS (SELECT DISTINCT item_id, hash(w[p:p + 12]) h FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) p FROM i WHERE len(w) >= 13))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (h)
"""

# The longest shared run of a pair: words that agree on one diagonal (place in the document less place in the item), counted in a row.
P6_LEAKED_SQL = P6_SQL.replace("SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (h)", "") + r""",
dp AS (SELECT doc_id, p, hash(w[p:p + 12]) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) p FROM d WHERE len(w) >= 13)),
ip AS (SELECT item_id, p, hash(w[p:p + 12]) AS h FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) p FROM i WHERE len(w) >= 13)),
m AS (SELECT DISTINCT doc_id, item_id, dp.p - ip.p AS diagonal, dp.p FROM dp JOIN ip USING (h)),
g AS (SELECT doc_id, item_id, diagonal, p - row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY p) AS run FROM m),
s AS (SELECT doc_id, item_id, count(*) + 12 AS span FROM g GROUP BY doc_id, item_id, diagonal, run)
SELECT item_id, suite, coalesce(documents, 0)::BIGINT AS documents, coalesce(longest_span, 0)::INT AS longest_span FROM eval_items LEFT JOIN (SELECT item_id, count(DISTINCT doc_id) AS documents, max(span) AS longest_span FROM s GROUP BY item_id) USING (item_id)
"""
