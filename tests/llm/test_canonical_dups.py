import json
import random

import pytest

from skeinworks.llm import canonical_dups as C

DDL = "kind string, id long, text string, is_json boolean"


@pytest.mark.parametrize(
    "a,b,same",
    [
        ("A b.", "a  B", True),
        ("It’s “x”…", "Its x", True),
        ("3.5 and 1,000", "35 and 1000", False),
        ("3.5", "3.5.", True),
        ("1, 2", "1 2", True),
        ("x-y", "xy", False),
        ("f(x)", "f x", False),
        ("$a$", "a", False),
        ("a​b c", "abc", True),
        ("f′(x)", "f(x)", False),
    ],
)
def test_canonical(a, b, same):
    assert (C.canonical(a) == C.canonical(b)) is same


def test_json_fields_in_any_order():
    one = json.dumps({"problem": "A b.", "level": "Level 1", "type": "T", "solution": "s"})
    two = json.dumps({"solution": "S", "type": "t", "problem": "a  b", "level": "level 1"}, indent=1)
    assert C.canonical_json(one) == C.canonical_json(two)
    assert C.canonical_json('{"problem": "a') is None and C.canonical_json("[1]") is None and C.canonical_json("") is None


def brute(rows):
    seen = {}
    for kind, i, text, js in rows:
        if i is None or not text or not text.strip():
            continue
        c = C.canonical_json(text) if js else C.canonical(text)
        if c is not None:
            seen.setdefault((kind, c), set()).add(i)
    return {(k[0], min(v), x) for k, v in seen.items() for x in v if x != min(v)}, {(k[0], min(v), len(v)) for k, v in seen.items()}


@pytest.mark.parametrize("max_bits", [1 << 28, 1 << 10])
def test_like_brute_force(spark, max_bits):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        t = f"word{rng.randrange(150)} 3.{rng.randrange(2)}"
        rows.append(("ab"[i % 2], i, rng.choice([t, t.upper(), f" {t}!", t.replace(" ", "​  ")]), False))
    rows += [("a", 500, None, False), ("a", 501, " ", False), ("a", None, "word1", False), ("j", 1, '{"problem": "x"}', True), ("j", 2, '{"problem": "X."}', True), ("j", 3, "{", True), ("a", 0, rows[0][2], False), ("a", 700, "y" * 100_000, False)]
    df = spark.createDataFrame([(*r, "x") for r in rows], DDL + ", h1 string").repartition(5)
    got = C.formatting_duplicates(df, max_bits=max_bits)
    pairs, groups = brute(rows)
    assert {tuple(r) for r in got.copies_of.select("kind", "keep_id", "copy_id").collect()} == pairs
    assert {tuple(r) for r in got.collapsed.select("kind", "keep_id", "copies").collect()} == groups


def test_hot_group(spark):
    df = spark.range(3000).selectExpr("'a' kind", "id", "case when id % 3 = 0 then 'Same text.' else 'text ' || id end text", "false is_json")
    got = C.formatting_duplicates(df)
    assert got.copies_of.count() == 999 and got.collapsed.filter("copies = 1000").count() == 1 and got.collapsed.count() == 2001


def test_empty(spark):
    got = C.formatting_duplicates(spark.createDataFrame([], DDL))
    assert got.copies_of.count() == 0 and got.collapsed.count() == 0
