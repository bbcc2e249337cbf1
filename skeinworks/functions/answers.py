"""Answers of an external model: token counts, routing, richness, and the form in which they are kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skeinworks.functions.text import squeeze_ends, strip_step_label

LEAST_STEPS, MOST_STEPS = 5, 8
NO_REASON = "Problem statement is under-specified or inconsistent."


def _count(usage: Column, path: str) -> Column:
    return F.trim(F.get_json_object(usage, path)).try_cast("double").cast("long")


def completion_tokens(usage: Column) -> Column:
    """Tokens of a completion from its usage object (JSON): the details' text or output tokens if positive, else the totals, else 0."""
    inner = [_count(usage, f"$.completion_tokens_details.{k}") for k in ("text_tokens", "output_tokens")]
    outer = [_count(usage, f"$.{k}") for k in ("output_tokens", "completion_tokens")]
    return F.coalesce(*(F.when(x > 0, x) for x in inner), *outer, F.lit(0))


def routed(difficulty: Column, easy, medium, hard) -> Column:
    """The setting of a difficulty; anything but easy and hard counts as medium."""
    d = F.lower(F.trim(F.coalesce(difficulty, F.lit(""))))
    return F.when(d == "easy", easy).when(d == "hard", hard).otherwise(medium)


def too_short(verdict: Column, raw_length: Column, tokens: Column, least_tokens: Column, least_chars: int = 1200) -> Column:
    """Whether an accepted answer has too few characters, or too few tokens where they are known."""
    few = raw_length < F.greatest(F.lit(least_chars), least_tokens * 4)
    return (verdict == "ok") & (few | (tokens > 0) & (tokens < F.greatest(F.lit(1), least_tokens)))


def richness(raw_length: Column, tokens: Column, steps: Column) -> Column:
    """What makes one answer richer than another, in this order."""
    return F.struct(raw_length.alias("raw_length"), tokens.alias("tokens"), steps.alias("steps"))


def kept_steps(steps: Column) -> Column:
    """Steps without labels, blank ones left out."""
    return F.filter(F.transform(F.coalesce(steps, F.array().cast("array<string>")), lambda s: strip_step_label(F.coalesce(s, F.lit("")))), lambda s: s != "")


def normal_answer(verdict: Column, idea: Column, steps: Column, final: Column) -> Column:
    """verdict, idea, steps, final and error of an answer as it is kept.

    A final answer 'wrong problem' settles the verdict and keeps the first step as its reason; an accepted answer needs a final
    answer, steps, an idea and LEAST_STEPS steps, and keeps at most MOST_STEPS of them.
    """
    text = lambda c: squeeze_ends(F.coalesce(c, F.lit("")))
    s, f, i = kept_steps(steps), text(final), text(idea)
    wrong = (f == "wrong problem") | (text(verdict) == "wrong_problem")
    error = (
        F.when(wrong, None).when(f == "", "empty_final_answer").when(F.size(s) == 0, "empty_solution_steps").when(i == "", "empty_key_idea").when(F.size(s) < LEAST_STEPS, "too_few_solution_steps")
    )
    reason = F.when(F.size(s) > 0, F.slice(s, 1, 1)).otherwise(F.array(F.lit(NO_REASON)))
    return F.struct(
        F.when(wrong, "wrong_problem").otherwise("ok").alias("verdict"),
        F.when(wrong, "").otherwise(i).alias("idea"),
        F.when(wrong, reason).otherwise(F.slice(s, 1, MOST_STEPS)).alias("steps"),
        F.when(wrong, "wrong problem").otherwise(f).alias("final"),
        error.alias("error"),
    )


def message_text(c: Column) -> Column:
    """A message's text from JSON: a string, a list of objects with a text (joined by line breaks), or one such object."""
    parts = F.from_json(c, "array<struct<text:string>>")
    one = F.get_json_object(c, "$.text")
    joined = F.array_join(F.filter(F.transform(parts, lambda p: p["text"]), lambda t: t.isNotNull()), "\n")
    return F.when(c.rlike(r"^\s*\["), joined).when(c.rlike(r"^\s*\{"), F.coalesce(one, F.lit(""))).otherwise(F.coalesce(c, F.lit("")))
