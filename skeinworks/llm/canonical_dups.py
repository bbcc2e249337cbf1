"""Duplicates that differ in formatting only: merged Bloom filters, then exact grouping of possible repeats.

Every record is reduced to a 128-bit hash of its canonical text. Each task builds two bitmaps over its
own rows, one of hashes seen once and one of hashes seen again; merging two such pairs keeps
``again |= again' | (once & once')`` and ``once |= once'``. A hash present in two tasks has all its bits
in both ``once`` maps, so the merged ``again`` map has no false negatives. Only rows that hit it are
shuffled and grouped exactly; the others are singletons and leave the map side as they are.

Defined results: rows with a null id are ignored; null or blank texts never count; repeated rows with
one id are one record; ties cannot occur as the smallest id of a group is unique; an empty table gives
empty frames; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks import runtime

HASHES = 4
BITS_PER_ROW = 16
MAX_BITS = 1 << 28
SEGMENT_BYTES = 1 << 16
JSON_FIELDS = ("problem", "level", "type", "solution")

# The punctuation that copies may differ in.
MARKS = ";:!?…"  # point and comma have their own rule
QUOTES = "\"'`´‘’‚‛“”„‟‹›«»「」『』〝〞〟＂＇｀ʼʻ❛❜❝❞"

_point = re.compile(r"(?<!\d)[.,]|[.,](?!\d)")
_odd = re.compile(r"[^\x20-\x7e]")
_drop_ascii = {ord(c): None for c in ";:!?\"'` \t\n\r\x0b\x0c"}


def _invisible(c: str) -> bool:
    return unicodedata.category(c) in ("Cf", "Cc", "Zs", "Zl", "Zp") or "︀" <= c <= "️" or c in "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ"


class _Drop(dict):
    """A translate table that decides on each character when it first meets it."""

    def __missing__(self, code: int):
        c = chr(code)
        gone = c in QUOTES or c in MARKS or c.isspace() or _invisible(c)
        self[code] = None if gone else code
        return self[code]


class _Unseen(dict):
    """Removes what cannot be seen but is no white space."""

    def __missing__(self, code: int):
        c = chr(code)
        self[code] = None if _invisible(c) and not c.isspace() else code
        return self[code]


_drop, _unseen = _Drop(), _Unseen()


def canonical(text: str) -> str:
    """The text without case, white space, invisible characters and loose punctuation."""
    if text.isascii():
        return _point.sub("", text.lower()).translate(_drop_ascii if text.isprintable() else _drop)
    return _point.sub("", text.translate(_unseen).casefold()).translate(_drop)


def canonical_json(line: str) -> str | None:
    """The canonical form of an object's fields in fixed order; None if the line does not parse to an object."""
    try:
        got = json.loads(line)
    except (ValueError, RecursionError):
        return None
    if not isinstance(got, dict):
        return None
    parts = []
    for k in JSON_FIELDS:
        v = got.get(k)
        parts.append(canonical(v if isinstance(v, str) else "" if v is None else json.dumps(v, sort_keys=True, ensure_ascii=False)))
    return "\x1f".join(parts)


def _digest(kind: str, is_json: bool, text: str | None) -> tuple[int, int] | None:
    if text is None or not text.strip():
        return None
    c = canonical_json(text) if is_json else canonical(text)
    if c is None:
        return None
    d = hashlib.blake2b(f"{kind}\x1e{c}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        kinds, ids, texts, js = (b.column(i).to_pylist() for i in range(4))
        got = [(k, i, d) for k, i, t, j in zip(kinds, ids, texts, js) if i is not None and (d := _digest(k, j, t))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in got], pa.string()), pa.array([i for _, i, _ in got], pa.int64()), pa.array([d[0] for *_, d in got], pa.int64()), pa.array([d[1] for *_, d in got], pa.int64())],
            names=["kind", "id", "h1", "h2"],
        )


def _positions(h1: np.ndarray, h2: np.ndarray, bits: int) -> np.ndarray:
    """HASHES bit positions for each hash, by double hashing."""
    a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * b) >> np.uint64(64 - bits.bit_length() + 1) for i in range(HASHES)])


def _numpy(b: pa.RecordBatch, k: int) -> np.ndarray:
    return b.column(k).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _build_filter(bits: int):
    """Two packed bitmaps of a partition: all its hashes, and those it holds more than once, set batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = again = None
        for b in batches:
            if not b.num_rows:
                continue
            if once is None:
                once, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
            pair = np.stack([_numpy(b, 0), _numpy(b, 1)], axis=1)
            pair = pair[np.lexsort((pair[:, 1], pair[:, 0]))]
            start = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]).any(axis=1)])
            pos = _positions(pair[start, 0].copy(), pair[start, 1].copy(), bits)
            several = (np.diff(np.r_[start, len(pair)]) > 1) | _all_set(once, pos)
            _set_bits(once, pos.ravel())
            _set_bits(again, pos[:, several].ravel())
        if once is not None:
            yield from _segments(once, again)

    return run


def _all_set(packed: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return ((packed[pos >> np.uint64(3)] >> (np.uint8(7) - (pos & np.uint64(7)).astype(np.uint8))) & 1).all(axis=0)


def _set_bits(packed: np.ndarray, positions: np.ndarray) -> None:
    np.bitwise_or.at(packed, positions >> np.uint64(3), np.uint8(128) >> (positions & np.uint64(7)).astype(np.uint8))


def _segments(once: np.ndarray, again: np.ndarray) -> Iterator[pa.RecordBatch]:
    size = min(SEGMENT_BYTES, len(once))
    for k in range(len(once) // size):
        o, a = once[k * size : (k + 1) * size], again[k * size : (k + 1) * size]
        if o.any():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(o.tobytes(), 1)], pa.binary()), pa.array([zlib.compress(a.tobytes(), 1)], pa.binary())], names=["segment", "once", "again"])


def _merge_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by segment; one pair of bitmaps is held at a time."""
    now, once, again = None, None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([zlib.compress(again.tobytes(), 1)], pa.binary())], names=["segment", "again"])

    for b in batches:
        for k, o, a in zip(*(b.column(i).to_pylist() for i in range(3))):
            o, a = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, a))
            if k != now:
                if now is not None and again.any():
                    yield out()
                now, once, again = k, o.copy(), a.copy()
            else:
                again |= a | (once & o)
                once |= o
    if now is not None and again.any():
        yield out()


def _test_filter(bits: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = min(SEGMENT_BYTES, bits // 8)
        again = np.zeros(bits // 8, np.uint8)
        for k, blob in shared.value:
            again[k * size : (k + 1) * size] = np.frombuffer(zlib.decompress(blob), np.uint8)
        for b in batches:
            pos = _positions(_numpy(b, 2), _numpy(b, 3), bits)
            maybe = _all_set(again, pos)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(maybe.astype(bool), pa.bool_())], names=["kind", "id", "h1", "h2", "maybe"])

    return run


@dataclass
class FormattingDuplicates:
    """collapsed: kind, keep_id, copies (all records, one row a group). copies_of: kind, keep_id, copy_id."""

    collapsed: DataFrame
    copies_of: DataFrame


def _filter_of(hashed: DataFrame, bits: int):
    merged = (
        hashed.select("h1", "h2")
        .mapInArrow(_build_filter(bits), "segment int, once binary, again binary")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(_merge_segments, "segment int, again binary")
    )
    return hashed.sparkSession.sparkContext.broadcast([(r[0], bytes(r[1])) for r in merged.collect()])  # at most bits / 8 bytes


_FLAGGED = "kind string, id long, h1 long, h2 long, maybe boolean"


def formatting_duplicates(records: DataFrame, max_bits: int = MAX_BITS) -> FormattingDuplicates:
    """Group records (kind string, id bigint, text string, is_json boolean) by canonical text within a kind.

    max_bits bounds the filter that is broadcast (32 MB as set). Beyond max_bits / BITS_PER_ROW rows the hashes are cut into
    ranges of at most so many rows, each in a folder of its own, and every range has its filter in turn: each range is read
    twice, as the one is below that size, so the filters stay as sharp at any number of rows.
    """
    spark = records.sparkSession
    runtime.ship_package(spark)
    hashed = records.select("kind", "id", "text", "is_json").mapInArrow(_hash_batches, "kind string, id long, h1 long, h2 long")
    ranges = max(1, -(-BITS_PER_ROW * records.count() // max_bits))  # a count of rows reads no text
    if ranges == 1:
        hashed = runtime.materialize(hashed, "canon")
        rows, bits = hashed.count(), 1 << 16
        while bits < min(max_bits, BITS_PER_ROW * rows):
            bits *= 2
        flagged = hashed.mapInArrow(_test_filter(bits, _filter_of(hashed, bits)), _FLAGGED)
    else:
        parts = runtime.materialize(hashed.withColumn("part", F.pmod(F.shiftright("h2", 20), F.lit(ranges)).cast("int")), "canon", partition_by="part")
        flagged = None
        for k in range(ranges):
            one = parts.filter(F.col("part") == k).drop("part")  # only this range's folder is read
            shared = _filter_of(one, max_bits)
            flagged = runtime.append(one.mapInArrow(_test_filter(max_bits, shared), _FLAGGED), flagged, "canon-flagged")
            shared.unpersist()
        rows = flagged.count()
        runtime.drop_materialized(parts)
    possible = runtime.materialize(flagged.filter("maybe").select("kind", "id", "h1", "h2"), "canon-possible")
    key = ["kind", "h1", "h2"]
    groups = possible.groupBy(*key).agg(F.min("id").alias("keep_id"), F.count("*").alias("seen"))
    repeated = runtime.materialize(groups.filter("seen > 1"), "canon-groups")
    # Groups with at least a thousandth of the rows number a thousand at most: those, and only those, are broadcast.
    hot = max(1000, rows // 1000)
    members = possible.join(F.broadcast(repeated.filter(F.col("seen") >= hot)), key).unionByName(possible.join(repeated.filter(F.col("seen") < hot), key))
    pairs = members.filter("id <> keep_id").select("kind", "keep_id", F.col("id").alias("copy_id")).distinct()
    counts = pairs.groupBy("kind", "keep_id").agg((F.count("*") + 1).alias("copies"))
    lone = flagged.filter("not maybe").select("kind", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("copies"))
    single = groups.filter("seen = 1").select("kind", "keep_id", F.lit(1).cast("long").alias("copies"))
    only_repeats = repeated.select("kind", "keep_id").join(counts.select("kind", "keep_id"), ["kind", "keep_id"], "left_anti").withColumn("copies", F.lit(1).cast("long"))
    return FormattingDuplicates(lone.unionByName(single).unionByName(counts).unionByName(only_repeats), pairs)


def test_table_records(spark, sf_dir: str) -> DataFrame:
    """The three record sets of the test tables as one frame of texts."""
    one = lambda t, i, c, j: runtime.table(spark, sf_dir, t).select(F.lit(t).alias("kind"), F.col(i).alias("id"), F.col(c).alias("text"), F.lit(j).alias("is_json"))
    return one("math_train", "row_id", "problem", False).unionByName(one("synth_refill", "synth_id", "problem", False)).unionByName(one("raw_lines", "line_id", "raw_line", True))


def p4_found(spark, sf_dir: str) -> DataFrame:
    pairs = formatting_duplicates(test_table_records(spark, sf_dir)).copies_of
    return pairs.select(F.col("kind").alias("table_name"), "keep_id", "copy_id")


def p4_collapsed(spark, sf_dir: str) -> DataFrame:
    got = formatting_duplicates(test_table_records(spark, sf_dir)).collapsed
    return got.select(F.col("kind").alias("table_name"), "keep_id", "copies")


def _canonical_sql(c: str) -> str:
    """canonical() for SQL without look-around: points between digits are set aside under private characters."""
    t = rf"regexp_replace(lower({c}), '\p{{Cf}}', '', 'g')"
    for mark, aside in ((r"\.", "chr(57344)"), (",", "chr(57345)")):
        for _ in range(2):  # twice, as matches must not overlap
            t = rf"regexp_replace({t}, '(\d){mark}(\d)', '\1' || {aside} || '\2', 'g')"
    gone = ".,;:!?…" + QUOTES.replace("'", "''")
    return rf"replace(replace(regexp_replace({t}, '[{gone}\s\p{{Z}}\p{{Cf}}\p{{Cc}}]', '', 'g'), chr(57344), '.'), chr(57345), ',')"


_FIELDS_SQL = " || chr(31) || ".join(_canonical_sql(f"coalesce(json_extract_string(raw_line, '$.{f}'), '')") for f in JSON_FIELDS)
_GROUPS_SQL = rf"""
WITH r AS (
  SELECT 'math_train' AS table_name, row_id AS id, {_canonical_sql('problem')} AS c FROM math_train WHERE NOT regexp_full_match(problem, '[\s\p{{Z}}]*')
  UNION ALL SELECT 'synth_refill', synth_id, {_canonical_sql('problem')} FROM synth_refill WHERE NOT regexp_full_match(problem, '[\s\p{{Z}}]*')
  UNION ALL SELECT 'raw_lines', line_id, {_FIELDS_SQL} FROM (SELECT * FROM raw_lines WHERE json_valid(raw_line)) WHERE json_type(raw_line) = 'OBJECT'),
g AS (SELECT *, min(id) OVER (PARTITION BY table_name, c) AS keep_id, count(*) OVER (PARTITION BY table_name, c) AS copies FROM r)
"""
P4_SQL = _GROUPS_SQL + "SELECT table_name, keep_id, id AS copy_id FROM g WHERE id <> keep_id"
P4_COLLAPSED_SQL = _GROUPS_SQL + "SELECT table_name, keep_id, copies FROM g WHERE id = keep_id"
