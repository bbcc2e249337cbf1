import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skeinworks.llm.cooccurrence import cooccurrence


def brute(rows, least):
    records = defaultdict(set)
    for r, items in rows:
        if r is not None:
            records[r] |= {x for x in items or [] if x}
    records = {k: v for k, v in records.items() if v}
    single, pairs = Counter(x for v in records.values() for x in v), Counter(p for v in records.values() for p in itertools.combinations(sorted(v), 2))
    n = len(records)
    return {(a, b, k, single[a], single[b], n, round(k * n / single[a] / single[b], 9)) for (a, b), k in pairs.items() if k >= least}


@pytest.mark.parametrize("heavy,dictionary", [(1 / 64, 10_000), (0.3, 10_000), (2.0, 10_000), (0.0, 10_000), (0.2, 0)])
def test_like_brute_force(spark, heavy, dictionary):
    rng = random.Random(2)
    rows = [(f"r{i % 180}", [f"i{min(int(rng.paretovariate(0.6)), 60)}" for _ in range(rng.randrange(0, 9))]) for i in range(200)]
    rows += [("r1", None), (None, ["i1", "i2"]), ("r2", [None, "", "i1"]), ("long", [f"i{k}" for k in range(61)]), ("r3", ["i1", "i1", "i2"])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "record string, items array<string>, code int").repartition(3)
    got = {(*r[:6], round(r[6], 9)) for r in cooccurrence(df, 3, heavy_share=heavy, dictionary_rows=dictionary).collect()}
    assert got == brute(rows, 3) and got


def test_colliding_codes_are_replaced(spark):
    """Codes of which several items share one are drawn anew until each item has its own."""
    rng = random.Random(4)
    rows = [(f"r{i}", [f"i{rng.randrange(12)}" for _ in range(5)]) for i in range(150)]
    df = spark.createDataFrame(rows, "record string, items array<string>")
    salts = []

    def code(c, salt):
        salts.append(salt)
        h = F.xxhash64(F.lit(salt), c)
        return h if salt == 2 else F.pmod(h, F.lit(7)).cast("long")

    got = {(*r[:6], round(r[6], 9)) for r in cooccurrence(df, 3, code=code).collect()}
    assert got == brute(rows, 3) and salts == [0, 1, 2]


def test_heavy_items_beyond_the_bound_are_light_ones(spark):
    rng = random.Random(5)
    rows = [(f"r{i}", [f"i{rng.randrange(20)}" for _ in range(12)]) for i in range(120)]
    df = spark.createDataFrame(rows, "record string, items array<string>")
    got = {(*r[:6], round(r[6], 9)) for r in cooccurrence(df, 3, max_heavy=3).collect()}
    assert got == brute(rows, 3)


def test_share_bound(spark):
    df = spark.createDataFrame([(i, ["a", "b"] if i < 3 else ["c"]) for i in range(100)], "record long, items array<string>")
    assert cooccurrence(df, 1, 300).count() == 1 and cooccurrence(df, 1, 301).count() == 0


def test_empty(spark):
    assert cooccurrence(spark.createDataFrame([], "record string, items array<string>"), 1).count() == 0
    assert cooccurrence(spark.createDataFrame([("a", [])], "record string, items array<string>"), 1).count() == 0
