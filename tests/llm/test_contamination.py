import random
import re
import time

import pytest

from skeinworks.llm.contamination import ItemIndex, contaminated

WORDS = re.compile(r"[^\W_]+")


def brute(docs, items, span):
    grams = lambda t: {tuple(w[i : i + span]) for w in [WORDS.findall(t.lower())] for i in range(len(w) - span + 1)} if t else set()
    d, i = {k: grams(t) for k, t in docs if k is not None}, {k: grams(t) for k, t in items if k is not None}
    return {(a, b) for a, x in d.items() for b, y in i.items() if x & y}


def longest(a, b):
    x, y = WORDS.findall(a.lower()), WORDS.findall(b.lower())
    return max((k for i in range(len(x)) for j in range(len(y)) for k in range(1, min(len(x) - i, len(y) - j) + 1) if x[i : i + k] == y[j : j + k]), default=0)


@pytest.mark.parametrize("item_words", [500_000, 0])
@pytest.mark.parametrize("span,run", [(13, 7), (5, 5), (6, 1)])
def test_like_brute_force(spark, item_words, span, run):
    rng = random.Random(span)
    word = lambda: f"w{rng.randrange(30)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(3, 30)))) for i in range(12)]
    docs = []
    for d in range(80):
        w = [word() for _ in range(rng.randrange(0, 50))]
        src = rng.choice(items)[1].split()
        a = rng.randrange(len(src))
        k = rng.randrange(0, len(w) + 1)
        docs.append((d, ", ".join(w[:k] + src[a : a + rng.choice([span - 1, span, span + 3])] + w[k:]).upper()))
    docs += [(900, None), (901, ""), (902, "_ _"), (None, docs[0][1]), (903, "這是 " + items[0][1]), (904, docs[1][1] + " filler" * 20_000)]
    items += [(50, None), (51, "")]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, item_id int").repartition(3)
    it = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int")
    got = contaminated(df, it, span, run, item_words).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items, span)
    text, item = dict(docs), dict(items)
    for r in got[:5]:
        if len(text[r.doc_id]) < 2000:
            assert r.words_shared == longest(text[r.doc_id], item[r.item_id])


def test_repetitive_text_takes_linear_work():
    """A run of equal words meets an item of such words on as many diagonals as there are places, not place by place."""
    index = ItemIndex([1, 2], ["zero " * 1500, " ".join("abc"[i % 3] for i in range(900)) + " end of it"])
    began = time.time()
    own, item, n = index.hits(["zero " * 3000, " ".join("abc"[i % 3] for i in range(2001)) + " end of it"])
    assert time.time() - began < 2
    best = {(a, b): max(n[(own == a) & (item == b)], default=0) for a in (0, 1) for b in (0, 1)}
    assert best == {(0, 0): 1500, (0, 1): 0, (1, 0): 0, (1, 1): 903}


@pytest.mark.parametrize("span,run", [(13, 7), (6, 3)])
def test_periodic_texts_like_brute_force(span, run):
    rng = random.Random(run)
    piece = lambda: ["xyzuv"[i % p] for p in [rng.randrange(1, 6)] for i in range(rng.randrange(1, 40))]
    text = lambda: " ".join(piece() + [f"w{rng.randrange(3)}"] * rng.randrange(0, 3) + piece() + piece())
    items, docs = [(i, text()) for i in range(8)], [(d, text()) for d in range(60)]
    own, item, n = ItemIndex([i for i, _ in items], [t for _, t in items], span, run).hits([t for _, t in docs])
    assert set(zip(own.tolist(), item.tolist())) == brute(docs, items, span)
    for d, i in list(set(zip(own.tolist(), item.tolist())))[:40]:
        assert n[(own == d) & (item == i)].max() == longest(docs[d][1], items[i][1])


def test_bounds_and_repeats(spark):
    words = " ".join(f"x{i}" for i in range(13))
    it = spark.createDataFrame([(1, words)], "item_id long, text string")
    docs = spark.createDataFrame([(1, words), (1, words), (2, words.replace("x6", "y")), (3, words.rsplit(" ", 1)[0]), (4, "a_" + words.replace(" ", "_") + "!")], "doc_id long, text string")
    assert sorted(tuple(r) for r in contaminated(docs, it).collect()) == [(1, 1, 13), (4, 1, 13)]


def test_empty(spark):
    docs, it = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert contaminated(docs, it).count() == 0
    assert contaminated(docs, it, item_words=-1).count() == 0
