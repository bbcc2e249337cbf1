import random
import time

import pytest

from skeinworks.llm.quota_sample import controlled_rounding, largest_remainder, quota_sample

PLAN = "plan_id int, record_set string, category string, target_pct int, min_rows long, sample_permille int"


@pytest.mark.parametrize("seed", range(60))
def test_rounding_keeps_both_margins(seed):
    rng = random.Random(seed)
    counts = [[rng.choice([0, 1, 3, 17, 400]) for _ in range(rng.randrange(1, 9))] for _ in range(1)]
    counts += [[rng.choice([0, 1, 3, 17, 400]) for _ in counts[0]] for _ in range(rng.randrange(0, 6))]
    quota = [rng.randrange(0, sum(r) + 1) for r in counts]
    got = controlled_rounding(quota, counts)
    assert [sum(r) for r in got] == quota
    exact = [[q * c / sum(r) if sum(r) else 0 for c in r] for q, r in zip(quota, counts)]
    for r, x, c in zip(got, exact, counts):
        assert all(abs(a - b) < 1 + 1e-9 and a <= n for a, b, n in zip(r, x, c))
    for j in range(len(counts[0])):
        assert abs(sum(r[j] for r in got) - sum(x[j] for x in exact)) < 1 + 1e-9


def test_largest_remainder():
    assert largest_remainder([(40, 10), (35, 10), (25, 10)], 10) == [4, 4, 2]
    assert largest_remainder([], 0) == []


def test_sample_has_exact_quotas(spark):
    rng = random.Random(3)
    names = ["easy", " Easy", "HARD ", "hard", "rare", None, " ", "other"]
    data = [(i, names[min(int(rng.paretovariate(0.7)) - 1, 7)], f"f{i % 7}", i) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, category string, stratum string, name int").repartition(4)
    plans = spark.createDataFrame([(1, "x", "easy", 60, 5, 500), (1, "x", "hard", 30, 5, 500), (1, "x", "rare", 10, 700, 500), (2, "x", "none", 100, 0, 100)], PLAN)
    got = quota_sample(df, plans, bucket_rows=4)
    clean = [(c or "").strip().lower() for _, c, _, _ in data]
    for r in got.report.collect():
        have = clean.count(r.category)
        need = max({"rare": 700}.get(r.category, 5) if r.plan_id == 1 else 0, 2000 * (500 if r.plan_id == 1 else 100) // 1000 * r.target_pct // 100)
        assert (r.need, r.available, r.met) == (need, have, have >= need)
        assert r.drawn == min(have, need)
    drawn = got.sample.collect()
    assert len({(r.plan_id, r.id) for r in drawn}) == len(drawn)
    assert all(clean[r.id] == r.category for r in drawn)


@pytest.mark.parametrize("max_strata", [20_000, 8])
def test_both_margins_hold_for_many_strata(spark, max_strata):
    """With 300 strata each keeps its share, rounded up or down; beyond max_strata the groups that share a column do."""
    rng = random.Random(7)
    data = [(i, rng.choice(["a", "b", "b", "c"]), f"f{min(int(rng.paretovariate(0.5)), 300)}") for i in range(6000)]
    df = spark.createDataFrame(data, "id long, category string, stratum string").repartition(4)
    plans = spark.createDataFrame([(1, "x", "a", 50, 0, 300), (1, "x", "b", 20, 0, 300), (1, "x", "c", 30, 0, 300)], PLAN)
    got = quota_sample(df, plans, max_strata=max_strata)
    drawn = [r.id for r in got.sample.collect()]
    assert len(drawn) == len(set(drawn)) == 1800
    quota = {r.category: r.quota for r in got.report.collect()}
    assert quota == {"a": 900, "b": 360, "c": 540}
    group = {f"f{k}": f"f{k}" for k in range(1, 301)}
    if max_strata == 8:
        group = {r.s: r.g for r in spark.range(1, 301).selectExpr("'f' || id s").selectExpr("s", "cast(pmod(xxhash64(s), 8) as string) g").collect()}
    have, size, taken = {}, {}, {}
    for i, c, f in data:
        have[c, group[f]] = have.get((c, group[f]), 0) + 1
        size[c] = size.get(c, 0) + 1
    for i in drawn:
        taken[data[i][1], group[data[i][2]]] = taken.get((data[i][1], group[data[i][2]]), 0) + 1
    exact = {k: quota[k[0]] * n / size[k[0]] for k, n in have.items()}
    assert all(abs(taken.get(k, 0) - x) < 1 + 1e-9 for k, x in exact.items())
    for g in set(group.values()):
        assert abs(sum(taken.get((c, g), 0) for c in "abc") - sum(exact.get((c, g), 0) for c in "abc")) < 1 + 1e-9


def test_rounding_of_a_large_table_is_quick():
    rng = random.Random(1)
    counts = [[rng.choice([0, 1, 2, 5, 30]) for _ in range(5000)] for _ in range(6)]
    quota = [sum(r) // k for r, k in zip(counts, (2, 3, 5, 7, 11, 13))]
    began = time.time()
    got = controlled_rounding(quota, counts)
    assert [sum(r) for r in got] == quota and time.time() - began < 20
    for j in range(5000):
        assert abs(sum(r[j] for r in got) - sum(q * c[j] / sum(c) for q, c in zip(quota, counts))) < 1 + 1e-9


def test_repeated_rows_null_ids_and_empty(spark):
    plans = spark.createDataFrame([(1, "x", "a", 100, 0, 500)], PLAN)
    df = spark.createDataFrame([(1, "a", None)] * 6 + [(None, "A", "s")] * 4, "id long, category string, stratum string")
    assert quota_sample(df, plans).sample.count() == 5
    none = quota_sample(spark.createDataFrame([], df.schema), plans)
    assert none.sample.count() == 0 and none.report.first().need == 0
