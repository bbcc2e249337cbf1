from pathlib import Path

import numpy as np
import pytest

from skeinworks.llm import answer_calibration as C
from skeinworks.llm import answer_defects as A

DDL = "answer_id long, problem string, solution_steps array<string>, final_answer string, answer_finish_reason string, pattern int"
P = "A train leaves Oslo carrying 575 marble ladders at 42.5 kilometres per hour. How many ladders does Ann hold after 3 days in Bergen?"
GOOD = ["Step 1: Since the bead contributes 16 and the chain contributes 138, the total is $154$.", "Step 2: Dividing by 7 gives 22, which matches the count of wheels."]
FR = ["On en déduit que Anne possède encore 12 boutons.", "Le cas des plaques est traité à la page 682 du cahier."]

# The labelled fixture that the cutoffs are held to.
LABELLED = [
    (P, GOOD, "42", "stop", None),
    (P, GOOD, "\\boxed{42}", "length", None),
    (P, ["We are told: " + P.split(". ")[0] + ".", "so the value is 12"], "17", "stop", None),
    (P, ["Sorry bookkeeping aside, the naive count of 10 overshoots by 2, so we correct it.", "It is impossible for $z$ to be negative, therefore only $w = 823$ survives."], "823", "stop", None),
    (P, ["The parameter stays free, hence the answer is not unique."], "wrong problem", "stop", None),
    (P, GOOD, "no solution", "stop", None),
    (P, GOOD, "\\emptyset", "stop", None),
    (P, [GOOD[0] + ' (In Rom one says "ริบบิ้น".)', "so the value is 5"], "5", "stop", None),
    (P, ["Let me look at the statement first.", "I'm sorry, but I must decline to solve this problem"], "I'm sorry, but I must decline to solve this problem", "stop", "refusal"),
    (P, [], "Unfortunately, I can't help with this one as an assistant.", "stop", "refusal"),
    (P, None, "Lo siento, no puedo resolver este problema.", "stop", "refusal"),
    (P, ["这道题我不便作答。"], "", "stop", "refusal"),
    ("Сколько шаров осталось в коробке?", ["К сожалению, я не могу помочь с этой задачей."], "", "stop", "refusal"),
    (P, [P.upper()], P.upper(), "stop", "copied_question"),
    (P, None, "Answer: " + P.replace(". ", ".\n\n"), "stop", "copied_question"),
    (P, ["Step 1: " + P.split(". ")[0] + "."], P.split(". ")[1], "stop", "copied_question"),
    (P, FR, "12", "stop", "other_language"),
    (P, ["把575个灯笼平均分成7份，每份的长度约为3.8米。", "由此可知，剩下的纽扣一共有215个。"], "215", "stop", "other_language"),
    ("Combien de billes faut-il pour remplir les 145 cases ?", FR, "12", "stop", None),
    ("Combien de billes faut-il pour remplir les 145 cases ?", GOOD, "12", "stop", "other_language"),
    (P, [GOOD[0], "Step 2: Factor the left-hand side of $26b^2 - 2b + 17 = 0$ and rea"], "", "length", "truncated_answer"),
    (P, GOOD, "\\frac{40}{", "stop", "truncated_answer"),
    (P, GOOD, "the total number of", None, "truncated_answer"),
    (P, [*GOOD, "Step 3:"], "", "stop", "truncated_answer"),
    (P, GOOD, None, "stop", "empty_answer"),
    (P, GOOD, " ​ ", "stop", "empty_answer"),
    (P, None, "\\boxed{}", "stop", "empty_answer"),
    (P, [], "N/A", "stop", "empty_answer"),
    (P, GOOD, '"final_answer": ""', "stop", "empty_answer"),
    (P, GOOD, "<answer></answer>", "stop", "empty_answer"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r[:4], 0) for i, r in rows], DDL)


def test_cutoffs_hold_on_labelled_rows(spark):
    filler = [(10_000 + i, (P, [GOOD[0], "so the value is %d" % i], str(i), "stop")) for i in range(300)]
    rows = list(enumerate(LABELLED))
    got = {}
    for r in A.defects(frame(spark, rows + filler + rows[:3]).repartition(3)).collect():
        got.setdefault(r.answer_id, []).append((r["rank"], r.defect))
    first = {i: min(v)[1] for i, v in got.items()}
    assert {i: first.get(i) for i, _ in rows} == {i: r[4] for i, r in rows}
    assert not [i for i in first if i >= 10_000]
    assert {d for _, d in got[20]} == {"truncated_answer", "empty_answer"}  # more than one label is kept


def test_nulls_everywhere_and_empty(spark):
    df = frame(spark, [(1, (None, None, None, None)), (None, (P, GOOD, "1", "stop")), (2, (P, [None, ""], "7", None)), (3, ("", [], "x" * 100_000, ""))])
    got = {(r.answer_id, r.defect) for r in A.defects(df).collect()}
    assert (1, "empty_answer") in got and not [x for x in got if x[0] in (2, None)]
    assert A.defects(df.limit(0)).count() == 0


@pytest.mark.parametrize("text,want", [("the cat is on the mat", "en"), ("der Hund ist nicht im Haus", "de"), ("12 + 3", None), ("これはペンです", "ja"), ("这是一支笔", "zh"), ("$x$ und $y$ sind die Zahlen", "de")])
def test_language(text, want):
    assert A.language(text) == want


def test_label_model_learns_which_function_is_noise():
    """Two good functions and a coin: the posterior follows the good ones."""
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.1
    vote = lambda acc: np.where(rng.random(len(y)) < acc, y, ~y)
    a, b, c = vote(0.95), vote(0.9), vote(0.55)
    pats, n = np.unique([f"{'-+'[i]}{'-+'[j]}{'-+'[k]}" for i, j, k in zip(a.astype(int), b.astype(int), c.astype(int))], return_counts=True)
    model = A.LabelModel([(0.9, 0.1)] * 3).fit(list(pats), n.astype(float))
    post = dict(zip(pats, model.posterior(list(pats))))
    assert post["++-"] > 0.6 and post["--+"] < 0.1 and post["+-+"] < post["++-"]
    assert np.allclose(A.LabelModel([(0.9, 0.1)]).fit([], np.zeros(0)).table, [[[0.9, 0.1]], [[0.1, 0.9]]])


SOME = "/root/testdata/sf0.01/answered_rows.parquet"


@pytest.mark.skipif(not Path(SOME).exists(), reason="no test tables")
def test_model_on_held_out_labelled_pairs(spark):
    """On the half that chose nothing, precision and recall hold, and the model beats a majority of its functions, which disagree on many rows."""
    answers = spark.read.parquet(SOME)
    got = C.calibrate(answers, 300)
    f1 = lambda x: 2 * x[0] * x[1] / max(1e-9, x[0] + x[1])
    for c, g in got.items():
        assert g["held_out"][0] >= 0.97 and g["held_out"][1] >= 0.85, (c, g["held_out"])
        assert f1(g["held_out"]) >= f1(g["majority"]) - 0.01, c
    assert sum(f1(g["held_out"]) - f1(g["majority"]) for g in got.values()) > 1
    voted = A.voted_rows(answers).collect()
    assert sum(any("+" in v and "-" in v for v in r.votes) for r in voted) > 0.2 * len(voted)
    made = C.damage([(r[1], r[4], r[6], None) for r in answers.select("answer_id", "problem", "verdict", "key_idea", "solution_steps", "answer_check", "final_answer").limit(50).collect()])
    assert {c for _, cs, _ in made for c in cs} == set(A.CLASSES)


@pytest.mark.skipif(not Path(SOME).exists(), reason="no test tables")
def test_no_function_is_made_of_others(spark):
    """Each function of a class votes differently on some two rows that are alike to all others of its class."""
    table = [tuple(r) for r in spark.read.parquet(SOME).select("problem", "solution_steps", "final_answer", "answer_finish_reason").collect()]
    rows = table + [r for r, _, _ in C.damage(table[:300])]
    seen = [A.votes(*r)[0] for r in rows] + [r.votes for r in A.voted_rows(spark.read.parquet(SOME)).collect()]
    for k, c in enumerate(A.CLASSES):
        patterns = {v[k] for v in seen}
        for f in range(len(A.FUNCTIONS[c][1])):
            others = {}
            for p in patterns:
                others.setdefault(p[:f] + p[f + 1 :], set()).add(p[f])
            assert any(len(x) > 1 for x in others.values()), (c, list(A.FUNCTIONS[c][1])[f])


def test_all_labels_are_kept(spark):
    rows = [(i, (P, [GOOD[0], "so the value is %d" % i], str(i), "stop")) for i in range(300)] + [(900, (P, [GOOD[0], "Step 2: Factor the left-hand side of $26b^2 - 2b + 17 = 0$ and rea"], "", "length"))]
    got = {(r.answer_id, r["class"]): r for r in A.labels(frame(spark, rows)).collect()}
    assert set(got) == {(900, "truncated_step"), (900, "empty_answer")}
    assert all(len(r.votes) == len(A.FUNCTIONS[c][1]) and r.posterior > A.CUTOFFS[c] for (_, c), r in got.items())


def test_recurring_breaks_are_found_and_recurring_endings_are_not(spark):
    """A break that many rows share does not make itself usual; endings that others close or go on from are told apart."""
    noun = ["wheels", "ladders", "buckets", "cards"]
    rows = [(i, (P, [GOOD[0], "Step 2: Dividing by %d gives 22, which matches the count of %s." % (i, noun[i % 4])], "42", "stop")) for i in range(200)]
    breaks = ["Step 2: Dividing by %d gives 22, which matches the cou", "Step 2: Dividing by %d gives 22", "Step 2: Dividing by %d gives 22, which matches"]
    rows += [(1000 + i, (P, [GOOD[0], breaks[i % 3] % i], "42", "stop")) for i in range(90)]
    rows += [(2000 + i, (P, [GOOD[0], "Step 2: Dividing by %d gives 22, which matches the count of %s" % (i, noun[i % 4])], "42", "stop")) for i in range(40)]
    rows += [(3000 + i, (P, [GOOD[0], "so the value is %d" % i], "42", "stop")) for i in range(40)]
    got = {r.answer_id: r.defect for r in A.defects(frame(spark, rows).repartition(3)).collect()}
    assert got == {1000 + i: "truncated_answer" for i in range(90)}
