import numpy as np
import pytest

from skeinworks.llm import mixing as M
from skeinworks.llm.mixing import mix_sources

MIX = "mix_id int, source_name string, target_weight double, max_repeats int"
pytestmark = pytest.mark.filterwarnings("ignore")


def docs(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, tokens int").repartition(3)


def test_weights_and_caps(spark):
    rows = [(i, "one two three " * (1 + i % 17), ["big", " Big", "BIG"][i % 3]) for i in range(600)] + [(1000 + i, "alpha beta " * (1 + i % 5), "small") for i in range(60)]
    rows += [(5000, None, "big"), (5001, "", "big"), (None, "x", "big"), (5002, "x", None), (5003, "x", " ")]
    mixes = spark.createDataFrame([(1, "big", 0.8, 1), (1, "small", 0.2, 4), (2, "big", 0.5, 2), (2, "gone", 0.5, 3)], MIX)
    got = mix_sources(docs(spark, rows), mixes)
    report = {(r.mix_id, r.source_name): r for r in got.report.collect()}
    assert abs(report[1, "big"].actual_weight - 0.8) < 0.005 and abs(report[1, "small"].actual_weight - 0.2) < 0.005
    assert report[2, "gone"].used_tokens == 0 and not report[2, "gone"].met and report[2, "big"].actual_weight == 1
    caps = {(r.mix_id, r.source_name): r.max_repeats for r in mixes.collect()}
    copies = got.copies.collect()
    assert len({(r.mix_id, r.doc_id) for r in copies}) == len(copies)
    assert all(1 <= r.copies <= caps[r.mix_id, r.source_name] for r in copies)
    for key, r in report.items():
        assert r.used_tokens == sum(c.tokens * c.copies for c in copies if (c.mix_id, c.source_name) == key)


def test_given_total_saturates_small_sources(spark):
    rows = [(i, "word " * 20, "a") for i in range(200)] + [(1000 + i, "word " * 20, "b") for i in range(4)]
    mixes = spark.createDataFrame([(1, "a", 0.5, 1), (1, "b", 0.5, 3)], MIX)
    got = mix_sources(docs(spark, rows), mixes, total_tokens=4000)
    report = {r.source_name: r for r in got.report.collect()}
    assert report["b"].copies == 12 and not report["b"].met
    assert abs(report["a"].used_tokens - 2000) <= 25


def test_scarce_source_does_not_shrink_the_mix(spark):
    rows = [(i, "word " * 20, "a") for i in range(500)] + [(9000, "word", "b")]
    mixes = spark.createDataFrame([(1, "a", 0.9, 1), (1, "b", 0.1, 2)], MIX)
    report = {r.source_name: r for r in mix_sources(docs(spark, rows), mixes).report.collect()}
    assert report["a"].used_documents == 500 and report["b"].copies == 2 and not report["b"].met


def test_empty(spark):
    mixes = spark.createDataFrame([(1, "a", 1.0, 2)], MIX)
    got = mix_sources(docs(spark, []), mixes)
    assert got.copies.count() == 0 and got.report.first().actual_weight == 0
    assert mix_sources(docs(spark, [(1, "x", "a")]), spark.createDataFrame([], MIX)).copies.count() == 0


def test_rates_depend_on_size(spark):
    """Sources are tilted towards long documents where they are repeated, towards short ones where they are thinned, within the cap."""
    rows = [(i, "word " * (1 + i % 40), "rare") for i in range(400)] + [(1000 + i, "word " * (1 + i % 40), "rich") for i in range(4000)]
    mixes = spark.createDataFrame([(1, "rare", 0.5, 4), (1, "rich", 0.5, 1)], MIX)
    got = mix_sources(docs(spark, rows), mixes, total_tokens=40_000)
    report = {r.source_name: r for r in got.report.collect()}
    assert report["rare"].met and report["rich"].met and abs(report["rare"].used_tokens - 20_000) <= 100
    taken = {"rare": {}, "rich": {}}
    for r in got.copies.collect():
        taken[r.source_name].setdefault(r.tokens > 20, []).append(r.copies)
    assert max(taken["rare"][True]) <= 4 and sum(taken["rare"][True]) > 1.5 * sum(taken["rare"][False])
    assert sum(taken["rich"].get(True, [])) < 0.5 * sum(taken["rich"][False])


def test_scarce_is_a_parameter(spark):
    """With scarce = 0 the scarcest source sets the size and every weight is met."""
    rows = [(i, "word", "a") for i in range(500)] + [(9000, "word", "b")]
    mixes = spark.createDataFrame([(1, "a", 0.9, 1), (1, "b", 0.1, 2)], MIX)
    report = {r.source_name: r for r in mix_sources(docs(spark, rows), mixes, scarce=0).report.collect()}
    assert (report["a"].copies, report["b"].copies) == (18, 2) and report["a"].met and report["b"].met
    assert not {r.source_name: r for r in mix_sources(docs(spark, rows), mixes).report.collect()}["b"].met


def _reference_rates(tokens, cap, wanted):
    """The rates of least relative entropy to one copy each that give the wanted tokens under the cap, by projected steps on the primal's multiplier."""
    lo, hi = -50.0, 50.0
    for _ in range(200):
        b = (lo + hi) / 2
        r = np.minimum(cap, np.exp(np.minimum(b * tokens / tokens.mean(), 50)))
        lo, hi = (b, hi) if (r * tokens).sum() < wanted else (lo, b)
    return np.minimum(cap, np.exp(np.minimum(lo * tokens / tokens.mean(), 50)))


def test_rates_are_those_of_a_numeric_solver(spark):
    """Copies follow the tilted rates: each document gets its rate rounded up or down, and no other rates of the same tokens are nearer to one copy each."""
    rng = np.random.default_rng(3)
    sizes = {"rare": rng.integers(1, 60, 500), "rich": rng.integers(1, 60, 3000)}
    rows = [(k * 10_000 + i, "word " * n, s) for k, s in enumerate(sizes) for i, n in enumerate(sizes[s].tolist())]
    mixes = spark.createDataFrame([(1, "rare", 0.5, 5), (1, "rich", 0.5, 2)], MIX)
    got = mix_sources(docs(spark, rows), mixes, total_tokens=60_000)
    copies = {r.doc_id: r.copies for r in got.copies.collect()}
    count = M._counter(M.TOKENIZER)
    for k, (s, cap) in enumerate((("rare", 5), ("rich", 2))):
        t = np.array([count("word " * n) for n in sizes[s].tolist()], float)
        r = _reference_rates(t, cap, 30_000)
        taken = np.array([copies.get(k * 10_000 + i, 0) for i in range(len(t))])
        assert np.all(taken >= np.floor(r - 1e-6)) and np.all(taken <= np.ceil(r + 1e-6))
        assert abs((taken * t).sum() - 30_000) <= 60
        flat = np.full(len(t), 30_000 / t.sum())
        far = lambda x: (x * np.log(x) - x + 1).sum()
        assert far(r) < far(flat) and np.ptp(r) > 0.3  # tilted by size


def test_infeasible_sources_are_reported_and_the_rest_keeps_its_proportion(spark):
    rows = [(i, "word " * 20, "a") for i in range(300)] + [(1000 + i, "word " * 20, "b") for i in range(100)] + [(2000, "word", "tiny")]
    mixes = spark.createDataFrame([(1, "a", 0.45, 1), (1, "b", 0.15, 1), (1, "gone", 0.2, 2), (1, "tiny", 0.2, 2)], MIX)
    report = {r.source_name: r for r in mix_sources(docs(spark, rows), mixes).report.collect()}
    assert {k: r.status for k, r in report.items()} == {"a": "rebalanced", "b": "rebalanced", "gone": "no documents", "tiny": "capped"}
    assert all(r.balanced for r in report.values()) and not any(r.met for r in report.values())
    assert report["a"].feasible_weight == pytest.approx(0.75, abs=0.002) and report["gone"].feasible_weight == 0


@pytest.mark.parametrize("text", ["a " * 70_000 + "b", "x" * 150_000, "one\n" * 60_000, "x" + " " * 9_000 + "y", "x" + "\n" * 9_000 + "y" + " " * 5_000, " " * 5_000 + "a  b"])
def test_token_counts_do_not_depend_on_length(text):
    """Texts beyond any length are counted as one."""
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(M.TOKENIZER, "rb") if x.strip())}
    assert M._counter(M.TOKENIZER)(text) == len(tiktoken.Encoding("t", pat_str=M.SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text))


def test_a_million_blanks():
    assert M._counter(M.TOKENIZER)("x" + " " * 1_000_000) > 1
