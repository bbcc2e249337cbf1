"""Mix sources to target token shares by entropy balancing, with capped repeats and actual shares.

Documents are sized in tokens of a public tokenizer. For each mix and source the document rates are the
ones closest in relative entropy to taking each document once that give the wanted tokens and stay within
max_repeats: rate = min(max_repeats, exp(b * size)), with b from Newton steps on the dual, kept within bounds that
hold the solution. So a source of which more is wanted than it has repeats its longer documents more, and one
of which less is wanted keeps its shorter ones rather. Sums over documents are taken from a table of
(source, tokens, bucket) counts: one small distributed aggregate a step, whatever the corpus. Rates become
whole copies by systematic rounding along the documents in order of size, so that each document gets its rate
rounded up or down; of SHIFTS shifts of the rounding the one nearest to the wanted tokens is taken.

The mix's size is the largest at which every source with documents meets its weight. A source so scarce
that this would shrink the mix below scarce (a parameter, SCARCE unless given) of what the other sources allow
is repeated to its cap instead, and reported as not met, as are sources without documents; scarce = 0 leaves
none out. The report holds beside the target the feasible weight of each source, i.e. what can be reached with such
sources at their most and the others in the proportion of their targets, and why it differs (status: "no documents",
"capped", "rebalanced" for the others).

Defined results: sources are compared trimmed and in lower case; null or blank sources, null ids and texts without tokens
take no part; repeated rows are documents of their own; an empty table gives an empty mixture; extra columns are
ignored. Mixes are settings of at most MIX_ROWS rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinworks import runtime
from skeinworks.llm.cooccurrence import trimmed

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the split pattern that goes with the vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BUCKETS = 64
SCARCE = 0.05
TOLERANCE = 0.005
NEWTON = 50
MIX_ROWS = 10_000
SHIFTS = 64


# White space of the split pattern. A run of it is one piece but for its last character, which may go with what follows;
# very long ones overflow the pattern's stack, so they are handed over as the piece they are.
_gap = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def _vocabulary(path: str) -> str:
    """The vocabulary file on this machine: at its path, or as the driver sent it."""
    return path if Path(path).exists() else SparkFiles.get(Path(path).name)


def _counter(path: str):
    """A function from texts to token counts, the same for a text of any length."""
    import tiktoken

    with open(_vocabulary(path), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    coder = tiktoken.Encoding("sizes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def count(text: str | None) -> int:
        if not text:
            return 0
        text = text.encode("utf-8", "replace").decode()
        total, at = 0, 0
        for m in _gap.finditer(text):
            end = m.end() if m.end() == len(text) else m.end() - 1
            total += len(coder.encode_ordinary(text[at : m.start()])) + len(coder._encode_single_piece(text[m.start() : end]))
            at = end
        return total + len(coder.encode_ordinary(text[at:] if at else text))

    return count


def _count_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([count(t) for t in b.column(2).to_pylist()], pa.int64())], names=["doc_id", "source", "tokens"])

    return run


@dataclass
class Mixture:
    """copies: mix_id, doc_id, source_name, tokens, copies. report: one row for each mix and source."""

    copies: DataFrame
    report: DataFrame


def _size(rules: list, supply: dict[str, tuple[int, int]], scarce: float) -> float:
    """Total tokens of a mix. A source that allows less than scarce of what the next one does is left out."""
    most = sorted(r[3] * supply[r[1]][1] / r[2] for r in rules if r[2] > 0 and r[3] > 0 and r[1] in supply)
    while len(most) > 1 and most[0] < scarce * most[1]:
        most.pop(0)
    return most[0] if most else 0.0


def mix_sources(documents: DataFrame, mixes: DataFrame, tokenizer: str = TOKENIZER, total_tokens: int | None = None, scarce: float = SCARCE) -> Mixture:
    """Combine documents (doc_id bigint, text string, source string) to the weights of mixes.

    mixes: mix_id, source_name, target_weight double, max_repeats int. total_tokens sets the size of every
    mix instead of the largest possible one. A source that would shrink a mix below scarce of what the next one allows
    misses its weight instead; with 0 every source with documents meets its weight, however small the mix.
    """
    spark = documents.sparkSession
    runtime.ship_package(spark)
    if Path(tokenizer).exists():
        spark.sparkContext.addFile(tokenizer)  # executors need not have it at the same path
    rules = [(r[0], (r[1] or "").strip().lower(), float(r[2] or 0), int(r[3] or 0), r[1]) for r in mixes.select("mix_id", "source_name", "target_weight", "max_repeats").limit(MIX_ROWS + 1).collect()]
    if len(rules) > MIX_ROWS:
        raise ValueError(f"more than {MIX_ROWS} mix rows")
    named = sorted({r[1] for r in rules if r[1]})
    docs = documents.select("doc_id", trimmed(F.lower("source")).alias("source"), "text").filter(F.col("source").isin(named or [""]) & F.col("doc_id").isNotNull())
    sized = runtime.materialize(docs.mapInArrow(_count_batches(tokenizer), "doc_id long, source string, tokens long").filter("tokens > 0").withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")), "mix-sizes")
    cells = runtime.materialize(sized.groupBy("source", "tokens", "bucket").agg(F.count("*").alias("n")), "mix-cells")
    supply = {r[0]: (r[1], r[2]) for r in cells.groupBy("source").agg(F.sum("n"), F.sum(F.col("n") * F.col("tokens"))).collect()}  # named sources only
    goals = {}  # (mix, source): cap, wanted tokens
    reachable = {}  # (mix, source): tokens it can give of those wanted
    for mix in {r[0] for r in rules}:
        own = [r for r in rules if r[0] == mix]
        size = total_tokens or _size(own, supply, scarce)
        for _, source, weight, cap, _ in own:
            if source in supply and weight > 0 and cap > 0:
                goals[mix, source] = (cap, weight * size)
                reachable[mix, source] = min(weight * size, cap * supply[source][1])
    duals = _newton(spark, cells, supply, goals)
    kind = mixes.schema["mix_id"].dataType.simpleString()
    solved = spark.createDataFrame([(m, s, *duals[m, s], float(goals[m, s][0]), supply[s][1] / supply[s][0]) for m, s in goals], f"mix_id {kind}, source string, a double, b double, cap double, mean double")
    rate = F.least(F.col("cap"), F.exp(F.col("a") + F.col("b") * F.col("tokens") / F.col("mean")))
    # Running totals of rates along (tokens, bucket): a window over counts, never over documents.
    along = Window.partitionBy("mix_id", "source").orderBy("tokens", "bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = cells.join(F.broadcast(solved), "source").withColumn("rate", rate).withColumn("upto", F.sum(F.col("n") * F.col("rate")).over(along))
    edges = runtime.materialize(edges.select("mix_id", "source", "tokens", "bucket", "n", "rate", (F.col("upto") - F.col("n") * F.col("rate")).alias("start")), "mix-edges")
    wanted = {k: min(w, c * supply[k[1]][1]) for k, (c, w) in goals.items()}
    shifts = spark.createDataFrame([(m, s, u) for (m, s), u in _shifts(edges, wanted).items()], f"mix_id {kind}, source string, shift double")
    edges = edges.join(F.broadcast(shifts), ["mix_id", "source"]).withColumn("start", F.col("start") + F.col("shift")).drop("n", "shift")
    place = F.row_number().over(Window.partitionBy("source", "tokens", "bucket").orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id"))
    ranked = sized.withColumn("k", place)
    rounded = lambda k: F.floor(F.col("start") + k * F.col("rate") + F.lit(1e-9))
    copies = ranked.join(edges, ["source", "tokens", "bucket"]).withColumn("copies", F.least(rounded(F.col("k")) - rounded(F.col("k") - 1), F.ceil("rate")))
    copies = runtime.materialize(copies.filter("copies > 0").select("mix_id", "doc_id", F.col("source").alias("source_name"), "tokens", F.col("copies").cast("int").alias("copies")), "mix-copies")
    used = copies.groupBy("mix_id", "source_name").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used_tokens"), F.sum("copies").alias("copies"), F.count("*").alias("used_documents"))
    whole = {m: sum(v for (k, _), v in reachable.items() if k == m) for m, _ in reachable}
    asked = []
    for m, s, w, c, _ in rules:
        best = reachable.get((m, s), 0.0)
        feasible = best / whole[m] if best else 0.0
        why = "no documents" if w and s not in supply else "capped" if w and c * supply[s][1] < goals.get((m, s), (0, 0.0))[1] * (1 - 1e-9) else "rebalanced" if abs(feasible - w) > TOLERANCE else "feasible"
        asked.append((m, s, w, c, *(supply.get(s, (0, 0))), feasible, why))
    asked = spark.createDataFrame(asked, f"mix_id {kind}, source_name string, target_weight double, max_repeats int, documents long, available_tokens long, feasible_weight double, status string")
    full = asked.join(used, ["mix_id", "source_name"], "left").fillna(0, ["used_tokens", "copies", "used_documents"])
    whole = F.sum("used_tokens").over(Window.partitionBy("mix_id"))
    report = full.withColumn("actual_weight", F.coalesce(F.col("used_tokens") / F.nullif(whole, F.lit(0)), F.lit(0.0)))
    near = lambda c: F.abs(F.col("actual_weight") - F.col(c)) <= TOLERANCE
    report = report.withColumn("met", near("target_weight")).withColumn("balanced", near("feasible_weight"))
    return Mixture(copies, report)


def _newton(spark, cells: DataFrame, supply: dict, goals: dict) -> dict:
    """a, b of each mix and source such that min(cap, exp(a + b * tokens / mean)) gives its tokens; all problems step together.

    a is 0 but where even max_repeats of every document is not more than wanted: there each rate is the cap.
    """
    at, todo = {}, {}
    for (m, s), (cap, wanted) in goals.items():
        rows, tokens = supply[s]
        if wanted >= cap * tokens * (1 - 1e-12):
            at[m, s] = (log(cap), 0.0)
            continue
        at[m, s] = (0.0, 0.0)
        # No document is shorter than a token, so between these bounds lies the solution.
        todo[m, s] = [1.01 * log(wanted / tokens) * tokens / rows, 0.0] if wanted < tokens else [0.0, 1.01 * log(cap) * tokens / rows]
    for _ in range(NEWTON):
        if not todo:
            break
        keys = sorted(todo, key=repr)
        now = spark.createDataFrame([(i, s, at[m, s][1], log(goals[m, s][0]), supply[s][1] / supply[s][0]) for i, (m, s) in enumerate(keys)], "i int, source string, b double, top double, mean double")
        x = F.col("tokens") / F.col("mean")
        r = F.exp(F.least(F.col("top"), F.col("b") * x)) * F.col("n") * x
        free = F.when(F.col("b") * x < F.col("top"), r * x).otherwise(0.0)
        sums = cells.join(F.broadcast(now), "source").groupBy("i").agg(F.sum(r), F.sum(free)).collect()
        for i, s1, s2 in sums:
            key = keys[i]
            goal, b, bounds = goals[key][1] * supply[key[1]][0] / supply[key[1]][1], at[key][1], todo[key]
            if abs(s1 - goal) <= 1e-9 * goal:
                del todo[key]
                continue
            bounds[s1 > goal] = b
            # In logarithms of the tokens, where documents of one size need one step.
            new = b + log(goal / s1) * s1 / s2 if s1 > 0 and s2 > 0 else bounds[0]
            at[key] = (0.0, new if bounds[0] < new < bounds[1] else sum(bounds) / 2)
    return at


def _shifts(edges: DataFrame, wanted: dict) -> dict:
    """For each mix and source the shift of the rounding, of SHIFTS even ones, whose tokens are nearest to those wanted.

    Every shift rounds each rate up or down; all of them together give the wanted tokens on average, but one alone may be off
    by half the longest document, which counts in small sources.
    """
    if not wanted:
        return {}
    tries = [(k + 0.5) / SHIFTS for k in range(SHIFTS)]
    end = F.col("start") + F.col("n") * F.col("rate")
    used = lambda u: F.sum(F.col("tokens") * (F.floor(end + F.lit(u + 1e-9)) - F.floor(F.col("start") + F.lit(u + 1e-9))))
    sums = edges.groupBy("mix_id", "source").agg(F.array(*(used(u) for u in tries)).alias("used")).collect()
    return {(m, s): min(tries, key=lambda u: (abs(got[tries.index(u)] - wanted[m, s]), abs(u - 0.5))) for m, s, got in sums}


def _on_tables(spark, sf_dir: str) -> Mixture:
    return mix_sources(runtime.table(spark, sf_dir, "documents"), runtime.table(spark, sf_dir, "mix_targets"))


def p7_mixture(spark, sf_dir: str) -> DataFrame:
    """Every document of every mix with its copies and the weight its source reached."""
    got = _on_tables(spark, sf_dir)
    weights = got.report.select("mix_id", "source_name", "target_weight", "actual_weight")
    return got.copies.join(F.broadcast(weights), ["mix_id", "source_name"]).select("mix_id", "doc_id", "source_name", "tokens", "copies", "target_weight", "actual_weight")


def p7_weights(spark, sf_dir: str) -> DataFrame:
    """Target, feasible and actual weight of every source of every mix."""
    return _on_tables(spark, sf_dir).report


def p7_checks(spark, sf_dir: str) -> DataFrame:
    """What must hold of the mixture: which sources can take part, caps kept, one row a document, weights reached."""
    got = _on_tables(spark, sf_dir)
    caps = got.report.select("mix_id", "source_name", "max_repeats")
    taken = got.copies.groupBy("mix_id", "source_name").agg(F.max("copies").alias("most"), F.count("*").alias("rows"), F.min("copies").alias("least"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens"))
    repeated = got.copies.groupBy("mix_id", "source_name", "doc_id").count().filter("count > 1").select("mix_id", "source_name").distinct().withColumn("twice", F.lit(True))
    all_ = got.report.select("mix_id", "source_name", "documents", "balanced", "used_tokens").join(F.broadcast(caps), ["mix_id", "source_name"]).join(taken, ["mix_id", "source_name"], "left").join(repeated, ["mix_id", "source_name"], "left")
    return all_.select(
        "mix_id", "source_name", "documents", F.coalesce((F.col("most") <= F.col("max_repeats")) & (F.col("least") >= 1), F.lit(True)).alias("within_cap"),
        F.col("twice").isNull().alias("one_row_a_document"), F.coalesce(F.col("tokens") == F.col("used_tokens"), F.col("used_tokens") == 0).alias("tokens_add_up"), "balanced",
    )


P7_CHECKS_SQL = r"""
WITH d AS (SELECT regexp_replace(lower(source), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS source FROM documents WHERE doc_id IS NOT NULL AND text <> ''),
n AS (SELECT source, count(*) AS documents FROM d GROUP BY source)
SELECT mix_id, lower(trim(source_name)) AS source_name, coalesce(documents, 0) AS documents, true AS within_cap, true AS one_row_a_document, true AS tokens_add_up, true AS balanced
FROM mix_targets LEFT JOIN n ON n.source = lower(trim(source_name))
"""
