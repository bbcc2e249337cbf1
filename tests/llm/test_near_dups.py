import itertools
import random
import re

import numpy as np
import pytest

from skeinworks.llm import near_dups as N
from skeinworks.llm import textops as tx


def shingles(text):
    w = re.findall("[a-z0-9]+", text.lower())
    return frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else ("few", tuple(w) or text.strip().lower())


def groups(sets, num, den):
    """Brute force: rows (smallest id, member) of the connected sets of alike records."""
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        alike = x == y if isinstance(x, tuple) or isinstance(y, tuple) else len(x & y) * den >= num * len(x | y)
        if alike:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {(find(i), i) for i in sets if find(i) != i}


def rows(df):
    got = [tuple(r) for r in df.select("group_id", "record_id").collect()]
    assert len(got) == len(set(got))
    return set(got)


def edited(rng, base, edits):
    w = base.split()
    for _ in range(edits):
        k = rng.randrange(len(w))
        w[k : k + rng.choice([0, 1])] = [f"w{rng.randrange(60)}"]
    return " ".join(w)


def problems(seed, n=60):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = " ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice([1, 2, 3, 4, 6, 12, 25, 40, 60])))
        out += [edited(rng, base, rng.randrange(0, 5)) for _ in range(rng.randrange(1, 4))]
    return out


@pytest.mark.parametrize("rare,full,block,bits", [(64, 1024, 8192, 20), (1, 1024, 8192, 16), (2, 2, 5, 12), (64, 1, 2, 12)])
def test_problems_like_brute_force(spark, rare, full, block, bits):
    texts = problems(rare) + [None, "", "  ", "Σ!", "σ !", "a b", "A, b.", "x " * 4000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    want = groups({i: shingles(t) for i, t in enumerate(texts) if t and t.strip()}, 3, 5)
    assert rows(N.near_duplicates(df, 3, 5, rare=rare, full=full, block=block, sketch_bits=bits)) == want
    assert want


@pytest.mark.parametrize("rare,full,block", [(64, 1024, 8192), (1, 1024, 8192), (1, 3, 4)])
def test_lists_like_brute_force(spark, rare, full, block):
    rng = random.Random(block)
    base = [[f"q{rng.randrange(25)}" for _ in range(rng.randrange(3, 14))] for _ in range(70)]
    lists = base + [b[:-1] + [f"q{rng.randrange(25)}"] for b in base] + [None, [], ["q1"], ["a", "b", "c", "d", None, "d"], ["d", "c", "b", "a"]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "id long, items array<string>")
    sets = {i: s for i, x in enumerate(lists) if len(s := frozenset(y for y in x or [] if y is not None)) >= 4}
    assert rows(N.near_duplicates(df, 3, 4, least_entries=4, rare=rare, full=full, block=block, sketch_bits=14)) == groups(sets, 3, 4)


def test_copies_null_ids_and_extra_columns(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(3, text, "x"), (None, text, "x"), (1, text, "y"), (3, text, "x"), (2, text.upper() + "!", "z")], "id long, text string, node string")
    assert rows(N.near_duplicates(df, 3, 5)) == {(1, 2), (1, 3)}


def test_one_group_of_copies_and_variants_in_blocks(spark):
    base = " ".join(f"t{i}" for i in range(30))
    texts = [base] * 50 + [base + f" extra{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert rows(N.near_duplicates(df, 3, 5, rare=1, full=4, block=8, sketch_bits=12)) == {(0, i) for i in range(1, 110)}


@pytest.mark.parametrize("most", [2, 3, 6])
def test_boilerplate_is_told_apart_by_longer_combinations(spark, most):
    """All records share a long opening, so every short combination is crowded; only some are alike."""
    rng = random.Random(most)
    opening = " ".join(f"open{i}" for i in range(14))
    texts = []
    for _ in range(40):
        body = " ".join(f"w{rng.randrange(500)}" for _ in range(rng.choice([6, 14, 30])))
        texts += [f"{opening} {body}", f"{opening} {edited(rng, body, 2)}"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    want = groups({i: shingles(t) for i, t in enumerate(texts)}, 3, 5)
    assert want and rows(N.near_duplicates(df, 3, 5, rare=1, full=6, block=8, sketch_bits=14, most=most)) == want


def test_every_token_frequent_and_a_hot_signature(spark):
    """20,000 records of one template that differ in one place and pairs of others: no token is rare."""
    words = " ".join(f"t{i}" for i in range(24))
    made = spark.range(20_000).selectExpr("id", f"case when id < 16000 then concat('{words} ', id % 4000) else concat_ws(' ', transform(sequence(0, 19), k -> concat('v', (id div 2 * 31 + k * (id div 2 % 7 + 1)) % 40)), if(id % 2 = 0, 'end', 'of it')) end text")
    got = N.near_duplicates(made.repartition(8), 3, 5, rare=2, sketch_bits=12)
    big = got.filter("group_id = 0 and record_id < 16000")
    assert big.count() == 15_999
    later = {i: shingles(t) for i, t in made.filter("id >= 19000").collect()}
    pairs = groups(later, 3, 5)
    label = {r.record_id: r.group_id for r in got.filter("record_id >= 19000").collect()}
    assert all(label.get(a, a) == label[b] for a, b in pairs)


def test_sets_that_share_a_node_get_new_ones(spark):
    def make(first, second, salt):
        return N.node_hashes(first, second, salt) if salt else first % np.uint64(5)

    texts = problems(9)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    want = groups({i: shingles(t) for i, t in enumerate(texts) if t and t.strip()}, 3, 5)
    assert rows(N.near_duplicates(df, 3, 5, sketch_bits=14, make=make)) == want


def test_load_of_counters_is_taken_off():
    """Counters that all hold 300 others tell a token of 400 records from one of 2; counts of one stay apart."""
    import zlib

    import pyarrow as pa

    total = np.full(1 << 8, 300, np.uint32)
    total[:4] = [1, 302, 700, 0]
    batch = pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([zlib.compress(total.tobytes())], pa.binary())], names=["segment", "counts"])
    out = next(N._merge_counts(iter([batch]))).to_pylist()[0]
    code = np.frombuffer(zlib.decompress(out["codes"]), np.uint8)
    assert out["load"] == 300 and code[:4].tolist() == [1, 2, int(N.quantise(np.array([400]))[0]), 0] and set(code[4:].tolist()) == {2}


def test_empty(spark):
    assert rows(N.near_duplicates(spark.createDataFrame([], "id long, text string"))) == set()
    assert rows(N.near_duplicates(spark.createDataFrame([], "id long, items array<string>"))) == set()


def test_default_is_four_fifths_and_bounds_are_checked(spark):
    with pytest.raises(ValueError):
        N.near_duplicates(spark.createDataFrame([], "id long, text string"), 6, 5)


def test_signatures_meet_for_every_alike_pair():
    """The prefix argument, over random sets, orders and classes."""
    rng = np.random.default_rng(5)
    for trial in range(300):
        num, den = [(3, 5), (3, 4), (4, 5)][trial % 3]
        size = int(rng.integers(1, 70))
        x = rng.choice(10_000, size, replace=False).astype(np.uint64)
        drop = int(rng.integers(0, size))
        y = np.unique(np.concatenate([x[drop:], rng.integers(20_000, 30_000, int(rng.integers(0, 12))).astype(np.uint64)]))
        common = len(np.intersect1d(x, y))
        if not len(y) or common * den < num * (len(x) + len(y) - common):
            continue
        plan = N.Plan(num, den, int(rng.integers(2, 5)), 64)
        code = lambda v: (2 + (tx.mix(v + np.uint64(trial)) % np.uint64(200))).astype(np.uint8)
        sets = [np.sort(tx.mix(v) >> np.uint64(14)) for v in (x, y)]
        found = [set(N.signatures(s, np.array([0, len(s)]), code(s), plan)[1].tolist()) for s in sets]
        assert found[0] & found[1], (trial, len(x), len(y), common)


def test_latin_words_of_bytes():
    import pyarrow as pa

    texts = [None, "", "abc DEF", "déjà-vu", "K İx", "日本abc", "a", "b"]
    h, off = tx.hash_latin_words(pa.array(texts))
    assert np.diff(off).tolist() == [len(re.findall("[a-z0-9]+", (t or "").lower())) for t in texts]


def test_crowded_signatures_stream_over_batches():
    """Rows of one signature over many batches: every row goes out once, in blocks, and neighbours are paired."""
    import pyarrow as pa

    node = np.arange(50, dtype=np.int64)
    cols = [np.full(50, 7), node, np.full(50, 9, np.int32), np.zeros(50, np.int64), np.zeros(50, np.int64)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + 6]) for c in cols], names=["sig", "node", "n", "b0", "b1"]) for i in range(0, 50, 6)]
    got = [r for b in N._bucket_pairs(3, 5, 4, 10)(iter(batches)) for r in b.to_pylist()]
    assert sorted((r["a"], r["block"]) for r in got if r["sig"] is not None) == [(i, i // 10) for i in range(50)]
    pairs = {(r["a"], r["b"]) for r in got if r["sig"] is None}
    assert {(i, i + 1) for i in range(49)} <= pairs and all(b - a <= N.NEIGHBOURS for a, b in pairs)
