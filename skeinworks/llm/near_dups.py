"""Near-duplicate records: prefixes of token combinations, exact verification, connected groups.

A record is a set of tokens: runs of three words of a text, or the entries of a list. Two records are
alike if their Jaccard similarity reaches a threshold, groups are the connected sets of alike records.

1. Frequencies of all tokens are summed over the whole collection in a table of at most 2^SKETCH_BITS counters
   (64 MB, whatever the input), sized from the number of records. The load that rare tokens put into a counter is taken off, so
   frequencies only steer the order of tokens, results are exact at any load, and tokens count as rare below three
   deviations of the load where that is more than RARE.
2. Tokens are ordered by that frequency, rarest first. A record misses at most n - ceil(t n) of its tokens
   in any record alike to it. Tokens of up to RARE records are indexed singly; frequent ones in
   combinations of K, by GROUPS hash groups, and the prefix is extended by the K - 1 tokens a group may
   share without a common combination. Two alike records then have at least one signature in common. K is
   chosen from the frequencies such that a combination is expected in few records. Sets too short for the
   extension go through tiers with fewer groups or none; tiers overlap by a factor 1 / t in size.
3. Signatures with the record's size and 128 parity bits are grouped; a pair must agree in size and in
   parity distance (an exact bound of the symmetric difference) to become a candidate. Of signatures met by
   more than FULL records, only neighbours become candidates at first.
4. Candidates are verified exactly on the two token sets, and linked records grouped by connected components.
   Crowded signatures all of whose records are by then in one group are done with. Records of the others go through steps
   2 to 4 again with combinations of one token more, up to MOST; those too short for that, or still crowded at the end, are
   compared, between different groups only, in blocks of BLOCK rows, each two blocks in a task of their own. None is left out.

Exact copies collapse before step 2 to one node (a 64-bit hash of the set, checked against a second one: if two sets share a
node, nodes are made anew), so a group of copies costs one node however large it is.

Defined results: null ids, null and blank texts and null lists are ignored; a text of fewer than three
words has no tokens and is alike only to records of the same words (of the same stripped, lower-cased
text if it has no word); repeated rows count once; an empty table gives an empty frame; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks import runtime
from skeinworks.llm import textops as tx
from skeinworks.operators.components import connected_components

SKETCH_BITS = 26
LEAST_SKETCH_BITS = 18
MOST = 6
RARE = 64
GROUPS = 8
LONG = 24
FULL = 1024
BLOCK = 8192
NEIGHBOURS = 4
CHUNK = 8192
SEEN = 500_000
NODE_FILTER_BITS = 1 << 28
U = np.uint64


# Token sets of a batch


def _text_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values, offsets, which rows count, and the content hash of rows without a token."""
    valid = pc.fill_null(pc.not_equal(pc.utf8_trim_whitespace(column), ""), False).to_numpy(zero_copy_only=False)
    h, offsets = tx.hash_latin_words(column)
    values, bounds = tx.shingle_sets(h, offsets, 3)
    few = np.flatnonzero(valid & (np.diff(bounds) == 0))
    content = np.zeros(len(column), U)
    for i in few.tolist():
        words = h[offsets[i] : offsets[i + 1]]
        content[i] = tx.run_hashes(words, len(words))[0] if len(words) else tx.hash_strings([column[i].as_py().strip().lower()])[0]
    return values, bounds, valid, content


def _list_sets(least: int):
    def sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        flat = pc.list_flatten(column)
        own = pc.list_parent_indices(column).to_numpy(zero_copy_only=False).astype(np.int64)
        own = own - (own[0] - _first_parent(column) if len(own) else 0)
        good = pc.is_valid(flat).to_numpy(zero_copy_only=False)
        values, bounds = tx.value_sets(tx.mix(tx.hash_strings(flat.filter(pa.array(good)).to_pylist())), own[good], len(column))
        return values, bounds, np.diff(bounds) >= least, np.zeros(len(column), U)

    return sets


def _first_parent(column: pa.Array) -> int:
    return next((i for i, n in enumerate(pc.list_value_length(column).to_pylist()) if n), 0)


def node_hashes(first: np.ndarray, second: np.ndarray | None, salt: int) -> np.ndarray:
    """64 bits of the two hashes of each set; the second one is there if salt is not 0."""
    return tx.mix(first + U(salt) * second if salt else first)


def _chunks(batches: Iterator[pa.RecordBatch], sets, key, check: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """ids, values, offsets, node, size and, if check, a second hash of each valid row, in chunks; rows that do not count are left out.

    key: the function that makes nodes of two hashes and a salt, and the salt.
    """
    for b in batches:
        for lo in range(0, b.num_rows, CHUNK):
            part = b.slice(lo, CHUNK)
            ids = part.column(0)
            values, bounds, valid, content = sets(part.column(1))
            ok = valid & pc.is_valid(ids).to_numpy(zero_copy_only=False)
            n = np.diff(bounds)
            if not ok.all():
                values = values[np.repeat(ok, n)]
                n, content = n[ok], content[ok]
                bounds = np.r_[0, np.cumsum(n)]
                ids = ids.filter(pa.array(ok))
            if not len(n):
                continue
            def of(start: int) -> np.ndarray:
                run = np.r_[U(0), np.cumsum(tx.mix(values + U(start)))]  # noqa: B023
                return (run[bounds[1:]] - run[bounds[:-1]]) * tx._BASE + n.astype(U) + tx.mix(content + U(start))  # noqa: B023

            make, salt = key
            first, second = of(0), of(77) if check or salt else None
            node = make(first, second, salt)
            yield ids.to_numpy(zero_copy_only=False).astype(np.int64), values, bounds, node.view(np.int64), n, tx.mix(second).view(np.int64) if check else None


# Frequencies


def quantise(count: np.ndarray) -> np.ndarray:
    """A count as one byte: itself up to 127, then four steps an octave, upwards."""
    c = np.maximum(count, 1).astype(np.float64)
    return np.where(count <= 127, count, np.minimum(255, 127 + np.ceil(4 * np.log2(c / 127)))).astype(np.uint8)


def count_of(code: int) -> float:
    return float(code) if code <= 127 else 127 * 2 ** ((code - 127) / 4)


def _members_and_counts(sets, bits: int, key):
    segment_bits = min(16, bits)
    fields = [("id", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("segment", pa.int32()), ("counts", pa.binary())]

    def rows(ids=(), node=(), check=(), segment=(), counts=()) -> pa.RecordBatch:
        size = max(len(ids), len(segment))
        cols = [pa.array(x, t) if len(x) else pa.nulls(size, t) for x, (_, t) in zip((ids, node, check, segment, counts), fields)]
        return pa.RecordBatch.from_arrays(cols, names=[f for f, _ in fields])

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        at, n = np.unique(np.concatenate(parts), return_counts=True)
        seg = at >> np.uint32(segment_bits)
        for s in np.unique(seg):
            lo, hi = np.searchsorted(seg, [s, s + 1])
            dense = np.zeros(1 << segment_bits, np.uint32)
            dense[at[lo:hi] & np.uint32((1 << segment_bits) - 1)] = n[lo:hi]
            yield rows(segment=[int(s)], counts=[zlib.compress(dense.tobytes(), 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for ids, values, _, node, _, check in _chunks(batches, sets, key, True):
            yield rows(ids, node, check)
            parts.append((values >> U(tx.SET_BITS - bits)).astype(np.uint32))
            held += len(values)
            if held > 1 << 23:
                yield from flush(parts)
                parts, held = [], 0
        if held:
            yield from flush(parts)

    return run


def _merge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by segment: sums to one byte each, occurrences by that byte, and the load of a counter.

    The load is what rare tokens put into a counter that they share, i.e. the median of the segment; it is taken off, so that on
    large collections a byte still tells how frequent the token is itself. A counter of 1 stays 1 and no other becomes it.
    """
    now, total = None, None

    def out() -> pa.RecordBatch:
        load = float(np.median(total))
        code = quantise(total if load < 2 else np.where(total > 1, np.maximum(2, total - int(load)), total))
        weight = np.bincount(code, weights=total.astype(np.float64), minlength=256)
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int32()), pa.array([zlib.compress(code.tobytes(), 1)], pa.binary()), pa.array([weight.tolist()], pa.list_(pa.float64())), pa.array([load])], names=["segment", "codes", "weight", "load"]
        )

    for b in batches:
        for k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            dense = np.frombuffer(zlib.decompress(blob), np.uint32)
            if k != now:
                if now is not None:
                    yield out()
                now, total = k, dense.astype(np.int64)
            else:
                total += dense
    if now is not None:
        yield out()


# Signatures


class Plan:
    """How tokens of a collection become signatures; t = num / den."""

    def __init__(self, num: int, den: int, combine: int, rare_code: int, groups: int = GROUPS, long: int = LONG):
        self.num, self.den, self.k, self.rare_code, self.groups = num, den, combine, rare_code, groups
        need = lambda overlap: next(s for s in range(1, 1 << 20) if self.overlap(s) >= overlap)
        self.short_from = need(combine)
        self.long_from = max(long, need(groups * (combine - 1) + 1), self.short_from)

    def overlap(self, n):
        """ceil(t n): what a record of n tokens must share with any that is alike."""
        return -(-self.num * n // self.den)

    def tiers(self, n: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Tier, number of groups (0: single tokens only), and which sizes go there."""
        below = lambda bound: n * self.num < bound * self.den  # n < bound / t
        yield 0, 0, below(self.short_from)
        yield 1, 1, (n >= self.short_from) & below(self.long_from)
        yield 2, self.groups, n >= self.long_from


def signatures(values: np.ndarray, bounds: np.ndarray, code: np.ndarray, plan: Plan, long_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit signature pairs of a chunk's sets; code is the frequency byte of each value.

    With long_only sets too short for combinations of plan.k give none.
    """
    own = tx.owners(bounds)
    order = np.argsort(own.astype(U) << U(50) | code.astype(U) << U(42) | values >> U(8), kind="stable")
    values, code = values[order], code[order]
    n = np.diff(bounds)
    rows, sigs = [], []
    for tier, groups, which in plan.tiers(n):
        mask = which[own]
        if not mask.any() or long_only and not groups:
            continue
        v, c, o = values[mask], code[mask], own[mask]
        start = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
        need = (n - plan.overlap(n) + 1)[o]
        frequent = (c > plan.rare_code) if groups else np.zeros(len(v), bool)
        gain = np.ones(len(v), np.int64)
        group = (tx.mix(v + U(7)) % U(max(1, groups))).astype(np.int64)
        if frequent.any():  # the first k - 1 tokens of a group add nothing
            f = np.flatnonzero(frequent)
            by = f[np.lexsort((f, group[f], o[f]))]
            new = np.r_[True, (o[by][1:] != o[by][:-1]) | (group[by][1:] != group[by][:-1])]
            place = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
            gain[by[place < plan.k - 1]] = 0
        total = np.cumsum(gain)
        before = total - gain - np.repeat((total - gain)[start], np.diff(np.r_[start, len(v)]))
        prefix = before < need
        single = prefix & ~frequent & (c > 1)  # a token counted once has no partner
        rows.append(o[single])
        sigs.append(tx.mix(v[single] * tx._BASE + U(tier)))
        f = np.flatnonzero(prefix & frequent)
        if len(f):
            by = f[np.lexsort((f, group[f], o[f]))]
            for last, h in _combine(v[by], o[by] * np.int64(max(1, groups)) + group[by], plan.k):
                rows.append(o[by][last])
                sigs.append(tx.mix(h * tx._BASE + U(tier + 8 * plan.k)))
    return np.concatenate(rows) if rows else np.zeros(0, np.int64), np.concatenate(sigs) if sigs else np.zeros(0, U)


def _combine(v: np.ndarray, key: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All combinations of k values that stand in one run of key: the last place and a hash."""

    def extend(at: np.ndarray, h: np.ndarray, left: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not left:
            yield at, h
            return
        shift = 1
        while True:
            ok = at + shift < len(v)
            ok[ok] = key[at[ok]] == key[at[ok] + shift]
            at, h = at[ok], h[ok]
            if not len(at):
                return
            yield from extend(at + shift, tx.mix(h * tx._BASE + v[at + shift]), left - 1)
            shift += 1

    yield from extend(np.arange(len(v)), tx.mix(v), k - 1)


def _parity(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set: the parity of its tokens' bit numbers."""
    bit = tx.mix(values + U(99)) & U(127)
    out = []
    some = np.flatnonzero(np.diff(bounds) > 0)
    for half in (0, 1):
        one = np.where((bit >> U(6)) == U(half), U(1) << (bit & U(63)), U(0))
        got = np.zeros(len(bounds) - 1, U)
        if len(some):
            got[some] = np.bitwise_xor.reduceat(one, bounds[some])
        out.append(got.view(np.int64))
    return out[0], out[1]


def _bitmap(shared, bits: int) -> np.ndarray:
    out, size = np.zeros(bits // 8, np.uint8), min(1 << 16, bits // 8)
    for k, blob in shared.value:
        out[k * size : (k + 1) * size] = np.frombuffer(zlib.decompress(blob), np.uint8)
    return out


def _emit_signatures(sets, plan: Plan, bits: int, shared, key, only=None):
    """only: a filter of nodes and its bits; other nodes, and sets too short for plan.k, give no signature then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = np.zeros(1 << bits, np.uint8)
        size = 1 << min(16, bits)
        for k, blob in shared.value:
            codes[k * size : (k + 1) * size] = np.frombuffer(zlib.decompress(blob), np.uint8)
        seen: set[int] = set()
        wanted = None if only is None else _bitmap(*only)
        for _, values, bounds, node, n, _ in _chunks(batches, sets, key):
            # One row for each node of this task: copies here need no second one.
            nodes, first = np.unique(node, return_index=True)
            fresh = np.array([x not in seen for x in nodes.tolist()], bool) & (n[first] > 0)
            if wanted is not None:
                fresh &= _in_filter(wanted, nodes)
            if len(seen) < SEEN:
                seen.update(nodes.tolist())
            keep = np.zeros(len(n), bool)
            keep[first[fresh]] = True
            values, n, node = values[np.repeat(keep, n)], n[keep], node[keep]
            bounds = np.r_[0, np.cumsum(n)]
            row, sig = signatures(values, bounds, codes[values >> U(tx.SET_BITS - bits)], plan, wanted is not None)
            lo, hi = _parity(values, bounds)
            yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(node[row]), pa.array(n[row].astype(np.int32)), pa.array(lo[row]), pa.array(hi[row])], names=["sig", "node", "n", "b0", "b1"])

    return run


# Candidates


def _may_be_alike(n1, n2, lo1, lo2, hi1, hi2, num: int, den: int) -> np.ndarray:
    """Whether sizes and parity bits allow two sets to reach num / den."""
    n1, n2 = n1.astype(np.int64), n2.astype(np.int64)
    need = -(-num * (n1 + n2) // (num + den))
    apart = np.bitwise_count((lo1 ^ lo2).view(U)).astype(np.int64) + np.bitwise_count((hi1 ^ hi2).view(U))
    return (den * np.minimum(n1, n2) >= num * np.maximum(n1, n2)) & (apart <= n1 + n2 - 2 * need)


_PAIR = ["sig", "a", "b", "n", "b0", "b1", "block"]
_PAIR_DDL = "sig long, a long, b long, n int, b0 long, b1 long, block int"


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([none, pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.nulls(len(a), pa.int32()), none, none, pa.nulls(len(a), pa.int32())], names=_PAIR)


def _pairs_within(sig, node, n, lo, hi, num: int, den: int, reach: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates among distinct rows sorted by (sig, node); with reach, only rows so close together."""
    at, shift = np.arange(len(sig)), 1
    while reach is None or shift <= reach:
        at = at[at + shift < len(sig)]
        at = at[sig[at] == sig[at + shift]]
        if not len(at):
            return
        to = at + shift
        ok = _may_be_alike(n[at], n[to], lo[at], lo[to], hi[at], hi[to], num, den)
        yield node[at[ok]], node[to[ok]]
        shift += 1


def _unique_pairs(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([np.minimum(*p) for p in parts]) if parts else np.zeros(0, np.int64)
    b = np.concatenate([np.maximum(*p) for p in parts]) if parts else np.zeros(0, np.int64)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    return _pair_batch(a[first], b[first])


def _bucket_pairs(num: int, den: int, full: int, block: int):
    """Streams rows sorted by (sig, node): pairs of each signature; of crowded ones neighbours, and the rows in numbered blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, crowded, count = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int64, np.int64)], None, 0
        parts, held = [], 0

        def hot_rows(rows: list[np.ndarray], place: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.nulls(len(place), pa.int64()), *(pa.array(x) for x in rows[2:]), pa.array((place // block).astype(np.int32))], names=_PAIR)

        def add(rows: list[np.ndarray], reach: int | None = None) -> None:
            nonlocal held
            for p in _pairs_within(*rows, num, den, reach):
                parts.append(p)
                held += len(p[0])

        def whole(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            """Rows of signatures that are complete."""
            if not len(rows[0]):
                return
            start = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
            size = np.diff(np.r_[start, len(rows[0])])
            big = np.repeat(size > full, size)
            add([x[~big] for x in rows])
            if big.any():
                add([x[big] for x in rows], NEIGHBOURS)
                yield hot_rows([x[big] for x in rows], (np.arange(len(big)) - np.repeat(start, size))[big])

        for b in batches:
            rows = [np.concatenate(x) for x in zip(carry, (c.to_numpy(zero_copy_only=False) for c in b.columns))]
            first = np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])][: len(rows[0])]
            rows = [x[first] for x in rows]
            if not len(rows[0]):
                continue
            if crowded is not None:  # more rows of a signature that did not fit
                end = int(np.searchsorted(rows[0], crowded, "right"))
                add([x[:end] for x in rows], NEIGHBOURS)
                if end > 1:  # the row carried for its neighbours went out before
                    yield hot_rows([x[1:end] for x in rows], count + np.arange(end - 1))
                    count += end - 1
                if end == len(rows[0]):
                    carry = [x[-1:] for x in rows]
                    continue
                rows, crowded = [x[end:] for x in rows], None
            cut = int(np.searchsorted(rows[0], rows[0][-1], "left"))
            yield from whole([x[:cut] for x in rows])
            carry = [x[cut:] for x in rows]
            if len(carry[0]) > max(full, block):
                crowded, count = carry[0][0], len(carry[0])
                add(carry, NEIGHBOURS)
                yield hot_rows(carry, np.arange(count))
                carry = [x[-1:] for x in carry]
            if held > 1 << 20:
                yield _unique_pairs(parts)
                parts, held = [], 0
        if crowded is None:
            yield from whole(carry)
        yield _unique_pairs(parts)

    return run


_CROSS = ["sig", "low", "high", "block", "node", "grp", "n", "b0", "b1"]


def _block_pairs(num: int, den: int):
    """Pairs of two blocks of one signature between different groups; rows come block pair by block pair."""

    def meet(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, low, high, block, node, grp, n, lo, hi = rows
        left, right = np.flatnonzero(block == low[0]), np.flatnonzero(block == high[0])
        parts, held = [], 0
        for g in np.unique(grp[left]):
            others = right[grp[right] != g]
            for i in left[grp[left] == g].tolist():
                to = others[others > i] if low[0] == high[0] else others
                ok = _may_be_alike(n[i : i + 1], n[to], lo[i : i + 1], lo[to], hi[i : i + 1], hi[to], num, den)
                if ok.any():
                    parts.append((np.full(int(ok.sum()), node[i]), node[to[ok]]))
                    held += len(parts[-1][0])
            if held > 1 << 20:
                yield _unique_pairs(parts)
                parts, held = [], 0
        yield _unique_pairs(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for b in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            rows = new if carry is None else [np.concatenate(x) for x in zip(carry, new)]
            while len(rows[0]):
                same = (rows[0] == rows[0][0]) & (rows[1] == rows[1][0]) & (rows[2] == rows[2][0])
                end = len(same) if same.all() else int(np.argmin(same))
                if end == len(same):
                    break
                yield from meet([x[:end] for x in rows])
                rows = [x[end:] for x in rows]
            carry = rows
        if carry is not None and len(carry[0]):
            yield from meet(carry)

    return run


# Verification


def _emit_sets(sets, bits: int, shared, key):
    """node, tokens of the nodes that a candidate pair names (a filter of fixed size lets through a few more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = _bitmap(shared, bits), set()
        for _, values, bounds, node, n, _ in _chunks(batches, sets, key):
            nodes, first = np.unique(node, return_index=True)
            first = first[_in_filter(wanted, nodes)]
            first = first[np.array([x not in seen for x in node[first].tolist()], bool)] if len(first) else first
            if len(seen) < SEEN:
                seen.update(node[first].tolist())
            keep = np.zeros(len(n), bool)
            keep[first] = True
            tokens = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n[keep])].astype(np.int32)), pa.array(values[np.repeat(keep, n)].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(node[keep]), tokens], names=["node", "tokens"])

    return run


def _filter_places(nodes: np.ndarray, bits: int) -> np.ndarray:
    h = nodes.view(U)
    return np.stack([(h * m) >> U(64 - bits.bit_length() + 1) for m in (tx._M1, tx._M2, tx._BASE)])


def _in_filter(bitmap: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    at = _filter_places(nodes, len(bitmap) * 8)
    return ((bitmap[at >> U(3)] >> (at & U(7)).astype(np.uint8)) & 1).all(axis=0)


def _fill_filter(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.zeros(bits // 8, np.uint8)
        for b in batches:
            at = _filter_places(b.column(0).to_numpy(zero_copy_only=False), bits).ravel()
            np.bitwise_or.at(packed, at >> U(3), np.uint8(1) << (at & U(7)).astype(np.uint8))
        size = min(1 << 16, len(packed))
        for k in range(len(packed) // size):
            part = packed[k * size : (k + 1) * size]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["segment", "blob"])

    return run


def _merge_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, on = None, None
    for b in batches:
        for k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            part = np.frombuffer(zlib.decompress(blob), np.uint8)
            if k != now:
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([zlib.compress(on.tobytes(), 1)], pa.binary())], names=["segment", "blob"])
                now, on = k, part.copy()
            else:
                on |= part
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([zlib.compress(on.tobytes(), 1)], pa.binary())], names=["segment", "blob"])


# The operator


def _node_filter(spark, nodes: DataFrame, count: int):
    """A broadcast filter of the nodes (column node), at most NODE_FILTER_BITS / 8 bytes, and its bits."""
    bits = 1 << 16
    while bits < min(NODE_FILTER_BITS, 16 * count):
        bits *= 2
    blobs = nodes.select("node").mapInArrow(_fill_filter(bits), "segment int, blob binary").repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge_filter, "segment int, blob binary").collect()
    return spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in blobs]), bits


def _members(records: DataFrame, sets, bits: int, make) -> tuple[DataFrame, DataFrame, tuple]:
    """members (id, node), the table of counters, and the key of the nodes.

    A node stands for one token set: where two sets share one, told by a second hash, all nodes are made anew with another salt.
    """
    salt = 0
    while True:
        first = runtime.materialize(records.mapInArrow(_members_and_counts(sets, bits, (make, salt)), "id long, node long, check long, segment int, counts binary"), "near-members")
        members = first.filter("id is not null")
        if members.groupBy("node").agg(F.min("check").alias("low"), F.max("check").alias("high")).filter("low < high").isEmpty():
            return runtime.keep_with(members.select("id", "node"), first), first.filter("segment is not null").select("segment", "counts"), (make, salt)
        runtime.drop_materialized(first)
        salt += 1


def _links(records: DataFrame, sets, num: int, den: int, sketch_bits: int, rare: int, full: int, block: int, most: int, make) -> tuple[DataFrame, DataFrame]:
    """members (id, node) of all records, and verified links (a, b) between nodes."""
    spark = records.sparkSession
    members, counters, key = _members(records, sets, sketch_bits, make)
    merged = counters.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge_counts, "segment int, codes binary, weight array<double>, load double").collect()
    weight = np.sum([r[2] for r in merged], axis=0) if merged else np.zeros(256)
    rows = max(2, members.count())
    # Beyond three deviations of what other tokens put into a counter its own frequency shows.
    rare = max(rare, int(3 * np.sqrt(np.median([r[3] for r in merged])))) if merged else rare
    # The frequency within which a prefix lies in most records.
    cut = np.searchsorted(np.cumsum(weight), weight.sum() * min(0.9, 1 - num / den + 0.15)) if weight.sum() else 1
    often = min(rows - 1.0, max(2.0, count_of(int(min(cut, 255)))))
    combine = min(4, max(2, ceil(log2(rows / rare) / log2(rows / often)))) if rows > rare else 2
    shared = spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in merged])  # 2^sketch_bits bytes
    plan_of = lambda k: Plan(num, den, k, int(quantise(np.array([rare]))[0]))
    links, only = None, None
    while True:
        plan = plan_of(combine)
        indexed = records.mapInArrow(_emit_signatures(sets, plan, sketch_bits, shared, key, only), "sig long, node long, n int, b0 long, b1 long")
        met = runtime.materialize(indexed.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(_bucket_pairs(num, den, full, block), _PAIR_DDL), "near-buckets")
        links = _more_links(links, records, sets, met.filter("sig is null"), num, den, key)
        hot = met.filter("sig is not null")
        if hot.isEmpty():
            runtime.drop_materialized(met)
            return members, links
        labels = connected_components(links).select(F.col("node").alias("a"), F.col("component").alias("grp"))
        marked = runtime.materialize(hot.join(labels, "a", "left").select("sig", F.col("a").alias("node"), F.coalesce("grp", "a").alias("grp"), "n", "b0", "b1", "block"), "near-crowded")
        runtime.drop_materialized(met, labels)
        mixed = marked.groupBy("sig").agg(F.min("grp").alias("least"), F.max("grp").alias("most")).filter("least < most").select("sig")
        left = runtime.materialize(marked.join(mixed, "sig"), "near-mixed")
        runtime.drop_materialized(marked)
        longer = plan_of(combine + 1).short_from if combine < most else 1 << 30
        # Records long enough for longer combinations are told apart by those; of the others each two blocks meet.
        links = _blocks(left.filter(F.col("n") * num < longer * den), links, records, sets, num, den, key)
        deeper = runtime.materialize(left.filter(F.col("n") >= longer).select("node").distinct(), "near-deeper")
        runtime.drop_materialized(left)
        count = deeper.count()
        if not count:
            return members, links
        only, combine = _node_filter(spark, deeper, count), combine + 1
        runtime.drop_materialized(deeper)


def _blocks(rows: DataFrame, links: DataFrame, records: DataFrame, sets, num: int, den: int, key) -> DataFrame:
    """The links, and those between different groups among crowded rows, found by comparing each two blocks of a signature in a task of their own."""
    if rows.isEmpty():
        return links
    last = rows.groupBy("sig").agg(F.max("block").alias("last"))
    spread = rows.join(last, "sig").withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    spread = spread.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).select(*_CROSS)
    crossed = spread.repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high", "block", "node").mapInArrow(_block_pairs(num, den), _PAIR_DDL)
    return _more_links(links, records, sets, crossed, num, den, key)


def _more_links(links: DataFrame | None, records: DataFrame, sets, candidates: DataFrame, num: int, den: int, key) -> DataFrame:
    """The links so far and the verified ones of the candidates (a, b), as one table."""
    pairs = runtime.materialize(candidates.select("a", "b").distinct(), "near-pairs")
    found, tokens = _verified(records, sets, pairs, num, den, key)
    out = runtime.append(found, links, "near-links")
    runtime.drop_materialized(pairs, tokens)
    return out


def _verified(records: DataFrame, sets, pairs: DataFrame, num: int, den: int, key) -> tuple[DataFrame, DataFrame]:
    """The pairs that are alike, and the table of token sets they are read from."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    shared, bits = _node_filter(records.sparkSession, ends, pairs.count())
    # Copies of one set in several tasks give equal rows; any of them serves.
    tokens = runtime.materialize(records.mapInArrow(_emit_sets(sets, bits, shared, key), "node long, tokens array<long>").groupBy("node").agg(F.first("tokens").alias("tokens")), "near-sets")
    left = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    shared_tokens = F.size(F.array_intersect("ta", "tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", shared_tokens.alias("k"), (F.size("ta") + F.size("tb")).alias("n"))
    return both.filter(F.col("k") * den >= (F.col("n") - F.col("k")) * num).select("a", "b"), tokens


def near_duplicates(
    records: DataFrame, num: int = 4, den: int = 5, least_entries: int = 1, sketch_bits: int | None = None, rare: int = RARE, full: int = FULL, block: int = BLOCK, most: int = MOST, make=node_hashes
) -> DataFrame:
    """group_id (smallest id of the group), record_id of every member but that one.

    records: id bigint and either text string or items array<string>. Alike: Jaccard similarity of at
    least num / den of the runs of three words, or of the distinct entries (of lists with at least
    least_entries of them). sketch_bits: if None, so many that a counter has a token or so, from LEAST_SKETCH_BITS to SKETCH_BITS.
    """
    if not 0 < num <= den:
        raise ValueError("the threshold must lie in (0, 1]")
    runtime.ship_package(records.sparkSession)
    by_text = "text" in records.columns
    sets = _text_sets if by_text else _list_sets(least_entries)
    if sketch_bits is None:  # a count of rows reads no text; records have some 2^6 tokens, lists fewer
        sketch_bits = min(SKETCH_BITS, max(LEAST_SKETCH_BITS, records.count().bit_length() + (5 if by_text else 3)))
    records = records.select(F.col("id").cast("long"), "text" if by_text else "items")
    members, links = _links(records, sets, num, den, sketch_bits, rare, full, block, most, make)
    labels = connected_components(links)
    placed = runtime.materialize(members.join(labels, "node", "left").select("id", F.coalesce("component", "node").alias("grp")), "near-placed")
    rows = placed.count()
    runtime.drop_materialized(labels, links, members)
    groups = runtime.materialize(placed.groupBy("grp").agg(F.min("id").alias("group_id"), F.max("id").alias("last"), F.count("*").alias("n")).filter("group_id < last").select("grp", "group_id", "n"), "near-groups")
    # Groups of a thousandth of all rows number a thousand at most; only those are broadcast.
    hot = max(1000, rows // 1000)
    out = placed.join(F.broadcast(groups.filter(F.col("n") >= hot)), "grp").unionByName(placed.join(groups.filter(F.col("n") < hot), "grp"))
    return out.filter("id <> group_id").select("group_id", F.col("id").alias("record_id")).distinct()


def problem_records(spark, sf_dir: str) -> DataFrame:
    one = lambda t, i: runtime.table(spark, sf_dir, t).select(F.col(i).alias("id"), F.col("problem").alias("text"))
    return one("math_train", "row_id").unionByName(one("synth_refill", "synth_id"))


def seed_records(spark, sf_dir: str) -> DataFrame:
    return runtime.table(spark, sf_dir, "synth_refill").select(F.col("synth_id").alias("id"), F.col("selected_seed_qids").alias("items"))


def p1_found(spark, sf_dir: str) -> DataFrame:
    problems = near_duplicates(problem_records(spark, sf_dir), 3, 5)
    seeds = near_duplicates(seed_records(spark, sf_dir), 3, 4, least_entries=4)
    tag = lambda df, f: df.select(F.lit(f).alias("field"), "group_id", "record_id")
    return tag(problems, "problem").unionByName(tag(seeds, "seed_qids"))


P1_SQL = r"""
WITH RECURSIVE r AS (SELECT row_id AS id, problem AS t FROM math_train UNION ALL SELECT synth_id, problem FROM synth_refill),
w AS (SELECT id, any_value(t) AS t, regexp_extract_all(lower(any_value(t)), '[a-z0-9]+') AS w FROM r WHERE id IS NOT NULL AND regexp_matches(t, '[^\s\p{Z}]') GROUP BY id),
f AS (SELECT 'problem' AS field, id, unnest(CASE WHEN len(w) < 3 THEN ['few ' || CASE WHEN len(w) > 0 THEN array_to_string(w, ' ') ELSE lower(trim(t)) END] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS x FROM w
  UNION ALL SELECT 'seed_qids', synth_id, unnest(q) FROM (SELECT synth_id, list_distinct(list_filter(selected_seed_qids, lambda x: x IS NOT NULL)) AS q FROM synth_refill) WHERE len(q) >= 4),
n AS (SELECT field, id, count(*) AS n FROM f GROUP BY ALL),
p AS (SELECT a.field, a.id AS a, b.id AS b, count(*) AS k FROM f a JOIN f b ON a.field = b.field AND a.x = b.x AND a.id < b.id GROUP BY ALL),
e AS (SELECT p.field, a, b FROM p JOIN n na ON na.field = p.field AND na.id = a JOIN n nb ON nb.field = p.field AND nb.id = b WHERE CASE p.field WHEN 'problem' THEN k * 5 >= 3 * (na.n + nb.n - k) ELSE k * 4 >= 3 * (na.n + nb.n - k) END),
l AS (SELECT field, a AS u, b AS v FROM e UNION ALL SELECT field, b, a FROM e),
c AS (SELECT field, u, v FROM l UNION SELECT c.field, c.u, l.v FROM c JOIN l ON l.field = c.field AND l.u = c.v)
SELECT field, least(u, min(v)) AS group_id, u AS record_id FROM c GROUP BY field, u HAVING min(v) < u
"""
