"""BM25, character n-gram cosine, copy scores and bridges.

Two shapes occur. Small collections are compared within blocks (one parent node, one pair of parents) by
joins on shared terms, all in Catalyst. A bounded set of queries against a corpus of any size goes
the other way round: the queries are broadcast after a check of their size, each corpus partition scores its own
rows and keeps its own best ones, and only those meet in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skeinworks import runtime
from skeinworks.functions import text as T
from skeinworks.operators.relational import top_k

K1, B = 1.5, 0.75
QUERY_ROWS = 100_000
QUERY_TERMS = 5_000_000


def term_frequencies(docs: DataFrame, doc: str, terms: Column) -> DataFrame:
    """doc, term, tf, dl (the document's length in terms)."""
    rows = docs.select(doc, terms.alias("__t")).withColumn("dl", F.size("__t"))
    return rows.select(doc, "dl", F.explode("__t").alias("term")).groupBy(doc, "dl", "term").agg(F.count("*").alias("tf"))


def bm25_statistics(tf: DataFrame, doc: str, documents: int, average: float) -> DataFrame:
    """term, idf."""
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    return df.select("term", F.log(1 + (documents - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))


def bm25_weight(average: float) -> Column:
    tf, dl = F.col("tf"), F.col("dl")
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / max(1.0, average)))


def bm25_pairs(docs: DataFrame, doc: str, terms: Column, pairs: DataFrame) -> DataFrame:
    """a, b, sim: mean of both directions' BM25 scores over the self scores, clipped to [0, 1].

    pairs: a, b. Only terms shared by a named pair are ever joined.
    """
    tf = runtime.materialize(term_frequencies(docs, doc, terms), "bm25")
    n, total = docs.agg(F.count("*"), F.sum(F.size(terms))).first()
    average = (total or 0) / n if n else 1.0
    weighted = tf.join(bm25_statistics(tf, doc, n, average), "term").withColumn("w", F.col("idf") * bm25_weight(average)).select(doc, "term", "tf", "w")
    self_score = weighted.groupBy(doc).agg(F.sum(F.col("tf") * F.col("w")).alias("self"))
    left = pairs.join(weighted.select(F.col(doc).alias("a"), "term", F.col("tf").alias("tfa"), F.col("w").alias("wa")), "a")
    both = left.join(weighted.select(F.col(doc).alias("b"), "term", F.col("tf").alias("tfb"), F.col("w").alias("wb")), ["b", "term"])
    scores = both.groupBy("a", "b").agg(F.sum(F.col("tfa") * F.col("wb")).alias("ab"), F.sum(F.col("tfb") * F.col("wa")).alias("ba"))
    out = scores.join(self_score.select(F.col(doc).alias("a"), F.col("self").alias("sa")), "a").join(self_score.select(F.col(doc).alias("b"), F.col("self").alias("sb")), "b")
    return out.select("a", "b", T.clip01((F.col("ab") / F.col("sa") + F.col("ba") / F.col("sb")) / 2).alias("sim"))


def _blocks(queries: DataFrame, query: str, terms: Column, rows: int | None = None, most: int | None = None) -> list[DataFrame]:
    """The queries in blocks by a hash of their id, each of about rows queries and most terms at most, so that a block can be broadcast."""
    rows, most = rows or QUERY_ROWS, most or QUERY_TERMS
    n, size = queries.agg(F.count("*"), F.sum(F.size(terms))).first()
    blocks = max(1, -(-n // rows), -(-(size or 0) // most))
    if blocks == 1:
        return [queries]
    blocks *= 2  # hashing does not cut evenly
    return [queries.filter(F.pmod(F.xxhash64(query), F.lit(blocks)) == k) for k in range(blocks)]


def bm25_top(docs: DataFrame, doc: str, terms: Column, queries: DataFrame, query: str, query_terms: Column, k: int, block_rows: int | None = None) -> DataFrame:
    """query, doc, score, rank: the k best documents with a positive score of every query, ties by id.

    Document statistics cover the corpus; scores are computed where the documents lie, for one block of queries after another.
    """
    spark = docs.sparkSession
    runtime.ship_package(spark)
    corpus = docs.select(F.col(doc).alias("__d"), terms.alias("__t"))
    # Each document's length under a null term, and its distinct terms: one pass gives the lengths and the query terms' frequencies.
    length = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.size("__t").cast("long").alias("n")))
    parts = corpus.select(F.explode(F.concat(length, F.transform(F.array_distinct("__t"), lambda t: F.struct(t.alias("term"), F.lit(1).cast("long").alias("n"))))).alias("p")).select("p.term", "p.n")
    kinds = f"q {queries.schema[query].dataType.simpleString()}, d {docs.schema[doc].dataType.simpleString()}, score double"
    local = None
    for block in _blocks(queries, query, query_terms, block_rows):
        asked = block.select(query, query_terms).collect()  # one block
        wanted = sorted({t for _, ts in asked for t in ts or []})
        terms_frame = F.broadcast(spark.createDataFrame([(t,) for t in [None, *wanted]], "term string").withColumnRenamed("term", "w"))  # query terms only
        df = {r[0]: (r[1], r[2]) for r in parts.join(terms_frame, F.col("term").eqNullSafe(F.col("w")), "left_semi").groupBy("term").agg(F.count("*"), F.sum("n")).collect()}
        n, total = df.pop(None, (0, 0))
        idf = {t: float(np.log(1 + (n - d + 0.5) / (d + 0.5))) for t, (d, _) in df.items()}
        shared = spark.sparkContext.broadcast(([(q, ts or []) for q, ts in asked], idf, (total or 0) / n if n else 1.0, k, to_arrow_type(queries.schema[query].dataType)))
        got = corpus.mapInArrow(_score_batches(shared), kinds)
        local = got if local is None else local.unionByName(got)
    best = top_k(local, ["q"], [F.col("score").desc(), F.col("d")], k)
    return best.select(F.col("q").alias(query), F.col("d").alias(doc), "score", "rank")


DENSE = 1 << 22


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, idf, average, k, query_type = shared.value
        column = {t: i for i, t in enumerate(sorted(idf))}
        # Postings of the query terms: for each term the queries that ask for it, with their weights.
        weights: dict[tuple[int, int], float] = {}
        for i, (_, ts) in enumerate(asked):
            for t in ts:
                if (c := column.get(t)) is not None:
                    weights[c, i] = weights.get((c, i), 0.0) + idf[t]
        keys = np.array(sorted(weights), np.int64).reshape(-1, 2)
        query_of, weight = keys[:, 1], np.array([weights[tuple(x)] for x in keys.tolist()])
        first = np.searchsorted(keys[:, 0], np.arange(len(column) + 1))
        # Terms that an eighth of the queries ask for are scored by one product of matrices, as far as that fits; the others by postings.
        asks = np.diff(first)
        common = np.argsort(-asks, kind="stable")[: max(0, DENSE * 4 // max(1, len(asked)))]
        common = common[asks[common] * 8 >= len(asked)]
        row_of = np.full(len(column), -1)
        row_of[common] = np.arange(len(common))
        table_of = np.zeros((len(asked), len(common)))
        for r, c in enumerate(common.tolist()):
            table_of[query_of[first[c] : first[c + 1]], r] = weight[first[c] : first[c + 1]]
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            ids = np.array(b.column(0).to_pylist(), dtype=object)
            for lo in range(0, len(ids), 1024):
                lists = b.column(1).slice(lo, 1024).to_pylist()
                length = np.array([len(ts) if ts else 0 for ts in lists], np.int64)
                code = np.array([column.get(t, -1) for ts in lists for t in ts or ()], np.int64)
                known = code >= 0
                met, f = np.unique((np.repeat(np.arange(len(lists)), length)[known] << 32) | code[known], return_counts=True)
                c, j = met & 0xFFFFFFFF, met >> 32
                v = f * (K1 + 1) / (f + K1 * (1 - B + B * length[j] / max(1.0, average)))
                dense = len(asked) * len(lists) <= DENSE
                tf = None
                if dense and len(common):
                    often = row_of[c] >= 0
                    tf = np.zeros((len(common), len(lists)))
                    tf[row_of[c[often]], j[often]] = v[often]
                    c, j, v = c[~often], j[~often], v[~often]
                n = first[c + 1] - first[c]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[c], n)
                key, value = query_of[at] * len(lists) + np.repeat(j, n), weight[at] * np.repeat(v, n)
                if dense:
                    score = np.bincount(key, value, len(asked) * len(lists)).astype(float)
                    if tf is not None:
                        score += (table_of @ tf).ravel()
                    least = 0.0
                    if len(lists) > k:  # what the k-th best of the query exceeds goes at once
                        table = score.reshape(len(asked), len(lists))
                        least = np.repeat(np.partition(table, len(lists) - k, axis=1)[:, len(lists) - k], len(lists))
                    met = np.flatnonzero((score > 0) & (score >= least))
                    score = score[met]
                else:
                    met, back = np.unique(key, return_inverse=True)
                    score = np.bincount(back, value, len(met))
                    met, score = met[score > 0], score[score > 0]
                held.append((met // max(1, len(lists)), ids[lo : lo + 1024][met % max(1, len(lists))], score))
            held = [_best(held, k)] if held else []
        if held and kind is not None:
            q, d, s = _best(held, k)
            yield pa.RecordBatch.from_arrays([pa.array([asked[i][0] for i in q.tolist()], query_type), pa.array(d.tolist(), kind), pa.array(s)], names=["q", "d", "score"])

    return run


def _best(parts: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query; ties at the cut by id, as in the final rank."""
    q, d, s = (np.concatenate([p[i] for p in parts]) for i in range(3))
    if not len(q):
        return q, d, s
    order = np.lexsort((d.astype(np.int64) if isinstance(d[0], int) else d.astype(str), -s, q))
    q, d, s = q[order], d[order], s[order]
    start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    return q[rank < k], d[rank < k], s[rank < k]


def copy_scores(docs: DataFrame, doc: str, text: str, seeds: DataFrame, seed: str, seed_text: str, least: float, block_rows: int | None = None) -> DataFrame:
    """doc, seed, score of at least least: 0.75 Jaccard of seed tokens + 0.25 Jaccard of digit runs; 0 if either has no token."""
    spark = docs.sparkSession
    runtime.ship_package(spark)
    sides = seeds.select(seed, T.seed_tokens(F.col(seed_text)).alias("t"), T.digit_runs(F.col(seed_text)).alias("n"))
    kinds = f"d {docs.schema[doc].dataType.simpleString()}, s {seeds.schema[seed].dataType.simpleString()}, score double"
    own = docs.select(F.col(doc).alias("d"), T.seed_tokens(F.col(text)).alias("t"), T.digit_runs(F.col(text)).alias("n"))
    scored = None
    for block in _blocks(sides, seed, F.concat("t", "n"), block_rows):
        shared = spark.sparkContext.broadcast(([(r[0], r[1], r[2]) for r in block.collect()], to_arrow_type(seeds.schema[seed].dataType)))
        got = own.mapInArrow(_copy_batches(shared, least), kinds)
        scored = got if scored is None else scored.unionByName(got)
    return scored.select(F.col("d").alias(doc), F.col("s").alias(seed), "score")


def _copy_batches(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, seed_type = shared.value
        words: dict[str, list[int]] = {}
        digits: dict[str, list[int]] = {}
        for i, (_, t, n) in enumerate(seeds):
            for w in t or []:
                words.setdefault(w, []).append(i)
            for w in n or []:
                digits.setdefault(w, []).append(i)
        words = {w: np.array(v) for w, v in words.items()}
        digits = {w: np.array(v) for w, v in digits.items()}
        size_t = np.array([len(t or []) for _, t, _ in seeds], float)
        size_n = np.array([len(n or []) for _, _, n in seeds], float)
        for b in batches:
            ids, out = b.column(0).to_pylist(), ([], [], [])
            for d, t, n in zip(ids, b.column(1).to_pylist(), b.column(2).to_pylist()):
                if not t:
                    continue
                both, same = np.zeros(len(seeds)), np.zeros(len(seeds))
                for w in t:
                    if w in words:
                        both[words[w]] += 1
                for w in n or []:
                    if w in digits:
                        same[digits[w]] += 1
                every, all_n = len(t) + size_t - both, len(n or []) + size_n - same
                score = 0.75 * both / every + 0.25 * np.divide(same, all_n, out=np.zeros(len(seeds)), where=all_n > 0)
                for i in np.flatnonzero((score >= least) & (size_t > 0)).tolist():
                    out[0].append(d)
                    out[1].append(seeds[i][0])
                    out[2].append(float(score[i]))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.schema.field(0).type), pa.array(out[1], seed_type), pa.array(out[2], pa.float64())], names=["d", "s", "score"])

    return run


def char_grams(c: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams of each blank-padded word, repeats kept; none for words shorter than n with their blanks."""
    words = F.filter(F.split(T.squeeze(F.lower(F.coalesce(c, F.lit("")))), " "), lambda w: w != "")

    def of(w: Column) -> Column:
        p = F.concat(F.lit(" "), w, F.lit(" "))
        def of_size(n: int) -> Column:
            places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(p) - n + 1))
            return F.when(F.length(p) >= n, F.transform(places, lambda i: F.substring(p, i, n))).otherwise(F.array().cast("array<string>"))

        return F.concat(*(of_size(n) for n in range(low, high + 1)))

    return F.flatten(F.transform(words, of))


def tfidf_pairs(docs: DataFrame, doc: str, grams: Column, pairs: DataFrame) -> DataFrame:
    """a, b, sim: cosine of smoothed tf-idf vectors of each named pair with a common gram."""
    tf = runtime.materialize(term_frequencies(docs, doc, grams), "tfidf")
    n = docs.count()
    idf = tf.groupBy("term").agg((F.log((1 + n) / (1 + F.count("*"))) + 1).alias("idf"))
    w = tf.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = w.groupBy(doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = w.join(norm, doc).select(doc, "term", (F.col("w") / F.col("norm")).alias("w"))
    left = pairs.select("a", "b").join(unit.select(F.col(doc).alias("a"), "term", F.col("w").alias("wa")), "a")
    both = left.join(unit.select(F.col(doc).alias("b"), "term", F.col("w").alias("wb")), ["b", "term"])
    return both.groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("sim"))
