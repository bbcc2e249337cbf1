"""Cutoffs of the label model, chosen on pairs labelled by construction and checked on held-out ones.

A bounded sample of rows (SAMPLE_ROWS, those with the smallest hashes of their ids) in which the model finds nothing is
damaged in every way that makes a defect: the last step is cut within a word, the final answer within a formula or emptied, the
steps are replaced by the question, by steps that answer a question in another language, or by a refusal. The labelled rows
get their votes beside the corpus, whose rows alone fit the models. One half of them chooses, for each class, the
cutoff of the best F1 at the class's share in the corpus; the other gives precision and recall of that cutoff, and of
a plain majority of the votes.

Defined results: null ids and rows without steps are not drawn; an empty table gives no rows to choose on, and the cutoffs stay
as they are.
"""

from __future__ import annotations

import random
from math import exp, log

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks import runtime
from skeinworks.llm import answer_defects as ad

SAMPLE_ROWS = 2000
RARELY = 20  # of so many rows one is quoted and cut at once
NEARLY = 0.003
EMPTY = ("", " ", "\\boxed{}", "$$", "N/A", "TBD", "<answer></answer>", "**Answer:**", "\\text{}", "none", "-", "...", "Final answer:")
CUT_FINALS = ("\\frac{%d}{", "\\boxed{%d", "(%d, ", "$%d + ", "x = %d + \\sqrt{", "%d +", "y = ", "%d -", "the value of", "the sum of the", "%d \\cdot", "so that")
REFUSALS = (
    "I'm sorry, but I can't help with that.", "I cannot solve this for you.", "Unfortunately I am unable to answer.", "As an AI assistant I must decline.", "Sorry, I will not provide an answer to this.", "My apologies, I am not able to work on that.",
    "Es tut mir leid, ich kann dabei nicht helfen.", "Leider kann ich diese Aufgabe nicht lösen.", "Désolé, je ne peux pas répondre.", "Je regrette, mais je dois refuser.", "Lo siento, no puedo ayudar con esto.", "Lamento decirle que prefiero no responder.",
    "К сожалению, я не могу ответить.", "Извините, но я вынужден отказаться.", "抱歉，我无法回答。", "对不起，这个我不能解答。", "申し訳ありませんが、お答えできません。", "क्षमा करें, मैं इसमें मदद नहीं कर सकता।", "ขออภัย ฉันไม่สามารถตอบได้", "عذرا، لا أستطيع حل هذه المسألة.",
)

Row = tuple  # problem, steps, final answer, finish reason


def damage(rows: list[Row], seed: int = 1) -> list[tuple[Row, set[str], set[str]]]:
    """The rows as they are and damaged, each with the classes it belongs to and those of which nothing is said."""
    rng = random.Random(seed)
    language = [ad.language("\n".join(x or "" for x in r[1] or [])) for r in rows]
    out: list[tuple[Row, set[str], set[str]]] = []
    for k, (problem, steps, final, finish) in enumerate(rows):
        steps = [x for x in steps or [] if x and x.strip()]
        if not steps or not problem:
            continue
        add = lambda s, f, classes=(), open_=(), end=finish: out.append(((problem, s, f, end), set(classes), set(open_)))  # noqa: B023, E731
        add(steps, final)
        add(steps, rng.choice(EMPTY), ["empty_answer"])
        add(steps, rng.choice(CUT_FINALS).replace("%d", str(rng.randrange(2, 900))), ["truncated_final"])
        first = problem[: problem.find(". ") + 1] or problem[: len(problem) // 2]
        add(["We are told: " + first, *steps], final)  # quoting a piece before solving is no defect
        last = steps[-1]
        inside = [i for i in range(len(last) // 3, len(last) - 2) if last[i - 1].isalpha() and last[i].isalpha()]
        if inside:
            add([*steps[:-1], last[: rng.choice(inside)]], final, ["truncated_step"], end=rng.choice((finish, "length")))
        if inside and rng.randrange(RARELY) == 0:
            add(["We are told: " + first, last[: rng.choice(inside)]], "", ["truncated_step", "empty_answer"], end=rng.choice((finish, "length")))
        whole = rng.choice((problem, problem.upper(), problem.replace(" ", "  "), "**" + problem + "**"))
        half = problem.rfind(". ", 0, max(2, len(problem) - 20)) + 1
        sentences = [x for x in problem.split(". ") if x.strip()]
        add(*rng.choice((([whole], whole), ([], whole), ([problem[:half] or problem], problem[half:].strip() or problem), (sentences, sentences[-1]))), ["copied_question"], ["truncated_step", "truncated_final", "empty_answer"])
        others = [j for j in (rng.randrange(len(rows)) for _ in range(12)) if language[j] and language[k] and language[j] != language[k]]
        if others:
            add(list(rows[others[0]][1]), final, ["other_language"])
        said = rng.choice(REFUSALS)
        final_too = rng.randrange(3)
        add([] if final_too == 2 else [said], said if final_too else "", ["refusal", *([] if final_too else ["empty_answer"])], ["other_language", "truncated_step", "copied_question"])
    return out


def choose(posterior: np.ndarray, label: np.ndarray, share: float) -> tuple[float, list[tuple[float, float, float]]]:
    """The cutoff and the curve (cutoff, precision, recall) at the posteriors that occur.

    Precision is that of a corpus where the class has the given share. Of the cutoffs with nearly the best F1 (by NEARLY) the
    lowest is taken, in the middle between the posteriors around it.
    """
    logit = lambda p: log(min(max(p, 1e-12), 1 - 1e-12) / (1 - min(max(p, 1e-12), 1 - 1e-12)))
    got = np.array([logit(p) for p in posterior.tolist()])
    at = sorted(set(got.round(6).tolist()))
    curve = []
    for low, high in zip([logit(0), *at], [*at, logit(1)]):
        cut = (low + high) / 2
        found = got > cut
        recall, false = found[label].mean() if label.any() else 0.0, found[~label].mean() if (~label).any() else 0.0
        hit = share * recall
        curve.append((cut, hit / max(1e-12, hit + (1 - share) * false), recall))
    f1 = [2 * p * r / (p + r) if p + r else 0.0 for _, p, r in curve]
    best = next(c for c, f in zip(curve, f1) if f >= max(f1) - NEARLY)
    return 1 / (1 + exp(-best[0])), [(1 / (1 + exp(-c)), float(p), float(r)) for c, p, r in curve]


def calibrate(answers: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 1) -> dict[str, dict]:
    """For each class: cutoff, curve, and precision and recall on the held-out half, of the model and of a majority of votes."""
    spark = answers.sparkSession
    rows = answers.select("answer_id", "problem", "solution_steps", "final_answer", "answer_finish_reason").filter("answer_id is not null")
    bad = ad.labels(answers, {c: 0.5 for c in ad.CLASSES}).select("answer_id").distinct()
    sound = rows.filter("size(solution_steps) > 0").dropDuplicates(["answer_id"]).join(bad, "answer_id", "left_anti")
    drawn = sound.orderBy(F.xxhash64(F.lit(seed), "answer_id"), "answer_id").limit(sample_rows).collect()  # at most sample_rows
    made = damage([(r[1], r[2], r[3], r[4]) for r in drawn], seed)
    first = (answers.agg(F.min("answer_id")).first()[0] or 0) - 1
    if not made:
        return {}
    extra = spark.createDataFrame([(first - k, *r) for k, (r, _, _) in enumerate(made)], "answer_id long, problem string, solution_steps array<string>, final_answer string, answer_finish_reason string")
    voted = ad.voted_rows(rows.unionByName(extra))
    models, _ = ad.models_of(voted.filter(F.col("answer_id") > first))
    got = {first - r[0]: r[1] for r in voted.filter(F.col("answer_id") <= first).collect()}  # the labelled rows only
    half = np.random.default_rng(seed).random(len(made)) < 0.5
    out = {}
    for n, c in enumerate(ad.CLASSES):
        use = [k for k, (_, _, unsaid) in enumerate(made) if c not in unsaid]
        votes = [got[k][n] for k in use]
        label, held = np.array([c in made[k][1] for k in use]), half[use]
        post = models[c].posterior(votes)
        cutoff, curve = choose(post[~held], label[~held], models[c].prior)
        rate = lambda found: (float((found & label & held).sum() / max(1, (found & held).sum())), float((found & label & held).sum() / max(1, (label & held).sum())))  # noqa: B023, E731
        most = np.array([v.count("+") > v.count("-") for v in votes])
        out[c] = {"cutoff": cutoff, "curve": curve, "held_out": rate(post > cutoff), "majority": rate(most), "rows": int(held.sum())}
    return out
