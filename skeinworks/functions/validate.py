"""Row validators as error codes: the first rule that fails, null for a sound row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skeinworks.functions import text as T

# Words and phrases the rules look for.
TASK_WORDS = "prove show find determine compute classify count evaluate disprove".split()
TASK_WORDS_ZH = "证明 求 求出 计算 确定 分类 计数 判断".split()
CONNECTORS = ("additionally", "furthermore", "moreover", "in addition", "另外", "此外", "并且", "同时")
TASK_VERBS = "prove|show|find|determine|compute|classify|count|evaluate|disprove|solve"
TASK_VERBS_ZH = "证明|求出|求|计算|确定|分类|计数|判断|解"
PLACEHOLDERS = (
    "new inequality", "additional constraint", "additional condition", "given a condition on", "given a constraint on", "include constraints",
    "certain property", "some value", "some constraint", "some condition", "under a new inequality", "with a new inequality",
    "specific constraints", "specific constraint", "specific steps", "specific step", "specific digit constraints", "specific group sizes",
    "certain points", "certain labeled points", "certain steps", "intermediate points", "different types", "new set of linear transformations",
    "new set of eigenvalue conditions", "new orthogonality conditions", "new proportionality conditions", "new collinearity conditions",
    "fixed number of games", "given conditions", "under the given conditions", "under given conditions", "specific pattern", "specific rule",
    "specified range", "modified equation", "modified polynomial", "modified function", "modified matrix", "specific symmetry property",
    "special symmetry property", "specific transformation", "certain transformation", "forced case split", "new scoring system", "additional term",
)

SPACES = r"[\s\p{Z}\x0b\x{85}\x{1c}-\x{1f}]"
_NORM = rf"regexp_replace(regexp_replace(regexp_replace(lower(coalesce(problem, '')), '{SPACES}+', ' ', 'g'), '^ | $', '', 'g'), '[`*_]', '', 'g')"
_CLAUSES = "[;；]|additionally|furthermore|moreover|in addition|另外|此外|并且|同时"
_TASKS = "|".join(TASK_WORDS + TASK_WORDS_ZH)
_CHAINED = rf"\b({TASK_VERBS})\b.{{0,220}}\b(and|then)\b.{{0,220}}\b({TASK_VERBS})\b"
_CHAINED_ZH = rf"({TASK_VERBS_ZH}).{{0,120}}(并|并且|且|同时|再).{{0,120}}({TASK_VERBS_ZH})"


def multi_task(problem: Column) -> Column:
    """Two question marks, task words in two clauses, two of them with a connector, or two task verbs joined by a word for and."""
    norm, raw = T.normalize_text(problem), F.coalesce(problem, F.lit(""))
    marks = (F.regexp_count(norm, F.lit(r"\?")) >= 2) | (F.regexp_count(raw, F.lit("？")) >= 2)
    clauses = F.size(F.filter(F.split(F.lower(raw), _CLAUSES), lambda c: c.rlike(_TASKS))) >= 2
    named = sum((F.when(norm.contains(w), 1).otherwise(0) for w in TASK_WORDS), F.lit(0)) + sum((F.when(raw.contains(w), 1).otherwise(0) for w in TASK_WORDS_ZH), F.lit(0))
    joined = (named >= 2) & norm.rlike("|".join(CONNECTORS))
    return marks | clauses | joined | norm.rlike(_CHAINED) | raw.rlike(_CHAINED_ZH)


def has_placeholder(norm: Column) -> Column:
    return norm.rlike("|".join(PLACEHOLDERS))


def surface_error(problem: Column) -> Column:
    n = T.normalize_text(problem)
    return F.when(F.length(n) < 8, "too_short").when(multi_task(problem), "multi_task").when(has_placeholder(n), "placeholder")


_NAMED = " + ".join([f"contains(n, '{w}')::INT" for w in TASK_WORDS] + [f"contains(p, '{w}')::INT" for w in TASK_WORDS_ZH])
SURFACE_SQL = rf"""SELECT row_id, CASE WHEN length(n) < 8 THEN 'too_short'
WHEN len(regexp_extract_all(n, '\?')) >= 2 OR len(regexp_extract_all(p, '？')) >= 2 OR len(list_filter(regexp_split_to_array(lower(p), '{_CLAUSES}'), lambda c: regexp_matches(c, '{_TASKS}'))) >= 2
  OR ({_NAMED} >= 2 AND regexp_matches(n, '{"|".join(CONNECTORS)}')) OR regexp_matches(n, '{_CHAINED}') OR regexp_matches(p, '{_CHAINED_ZH}') THEN 'multi_task'
WHEN regexp_matches(n, '{"|".join(PLACEHOLDERS)}') THEN 'placeholder' END AS reason FROM (SELECT row_id, coalesce(problem, '') AS p, {_NORM} AS n FROM math_train)"""


def answer_verdict() -> Column:
    """ok, fail or wrong_problem as written; anything else is read from the final answer."""
    v = F.lower(F.trim(F.coalesce("verdict", F.lit(""))))
    wrong = F.lower(F.trim(F.coalesce("final_answer", F.lit("")))) == "wrong problem"
    return F.when(wrong, "wrong_problem").when(v.isin("ok", "fail", "wrong_problem"), v).when(F.trim(F.coalesce("final_answer", F.lit(""))) != "", "ok").otherwise("fail")


def answer_error() -> Column:
    """missing_answer, missing_steps or few_steps for rows that claim a solution."""
    steps = F.size(F.coalesce("solution_steps", F.array()))
    ok = answer_verdict() == "ok"
    return F.when(ok & (F.trim(F.coalesce("final_answer", F.lit(""))) == ""), "missing_answer").when(ok & (steps == 0), "missing_steps").when(ok & (steps < 5), "few_steps")


ANSWER_SQL = """
WITH a AS (SELECT answer_id, lower(trim(coalesce(any_value(verdict), ''))) AS v, trim(coalesce(any_value(final_answer), '')) AS f, coalesce(len(any_value(solution_steps)), 0) AS n FROM answered_rows GROUP BY answer_id),
b AS (SELECT *, CASE WHEN lower(f) = 'wrong problem' THEN 'wrong_problem' WHEN v IN ('ok', 'fail', 'wrong_problem') THEN v WHEN f <> '' THEN 'ok' ELSE 'fail' END AS verdict_fixed FROM a)
SELECT answer_id, verdict_fixed, CASE WHEN verdict_fixed = 'ok' AND f = '' THEN 'missing_answer' WHEN verdict_fixed = 'ok' AND n = 0 THEN 'missing_steps' WHEN verdict_fixed = 'ok' AND n < 5 THEN 'few_steps' END AS error, least(n, 8)::INT AS steps FROM b
"""

# Phrases that leave a condition unsaid.
WEAK_PHRASES = [
    "specific conditions", "specific configuration", "new set of conditions", "new conditions", "alter the constraints", "different set of angles", "a quadratic inequality", "a linear system", "a specific obstacle", "new divisibility conditions",
    "specific role constraints", "specific digit constraints", "specific group sizes", "certain labeled points", "specific steps", "fixed number of games", "specific pattern", "specific rule", "specified range", "given conditions",
    "under given conditions", "modified equation", "modified polynomial", "modified function", "modified matrix", "specific symmetry property", "special symmetry property", "specific transformation", "forced case split", "new scoring system", "additional term",
]
# Phrases that name no object.
GENERIC_PHRASES = [
    "multiple teams", "different types of plants", "different types of", "specific constraints", "specific digit constraints", "specific group sizes", "specific steps", "specific labeled points", "certain labeled points", "certain points", "intermediate points",
    "fixed number of games", "specific pattern", "specific rule", "specified range", "given conditions", "modified equation", "modified polynomial", "modified function", "specific symmetry property", "specific transformation", "additional term",
]
# Words by which a problem's family is told, the first family that fits.
FAMILIES = {
    "probability": ["probability", "random", "uniform", "expected value", "deck", "dice", "card", "sample space", "chance"],
    "geometry": ["triangle", "circle", "ellipse", "line", "point", "angle", "perimeter", "area", "coordinate", "geometry", "vector", "plane"],
    "counting": ["number of ways", "count", "arrange", "permutation", "combination", "subset", "select", "choose"],
    "equation_system": ["solve", "equation", "system", "congruence", "mod", "root", "solution"],
}
OTHER_FAMILY = "algebraic_object"


def has_phrase(text: Column, phrases: list[str]) -> Column:
    """Whether one of the phrases stands in a normalised text."""
    return text.rlike("|".join(phrases))


def line_error(line: Column, latent: bool = False) -> Column:
    """missing or underspecified for a line of a plan; latent lines must not be generic either."""
    t = T.normalize_text(line)
    vague = has_phrase(t, [*WEAK_PHRASES, *PLACEHOLDERS, *(GENERIC_PHRASES if latent else [])])
    return F.when(F.trim(t) == "", "missing").when(vague, "underspecified")


def list_error(lines: Column, least: int, latent: bool = False) -> Column:
    """invalid (no list), too_short (fewer than least lines with text) or underspecified."""
    own = F.filter(lines, lambda x: T.squeeze_ends(F.coalesce(x, F.lit(""))) != "")
    return F.when(lines.isNull(), "invalid").when(F.size(own) < least, "too_short").when(F.exists(own, lambda x: F.coalesce(line_error(x, latent), F.lit("")) == "underspecified"), "underspecified")


def problem_family(text: Column) -> Column:
    t, out = T.normalize_text(text), F.lit(OTHER_FAMILY)
    for name, words in reversed(FAMILIES.items()):
        out = F.when(has_phrase(t, words), name).otherwise(out)
    return out


def report_error(well_posed: Column, sound: Column, counterexample: Column, verdict: Column, hard: Column) -> Column:
    """What a report on a problem's truth fails by; a counterexample counts for hard problems only."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return (
        F.when(no(well_posed), "not_well_posed").when(no(sound), "unsound").when(hard & F.coalesce(counterexample, F.lit(False)), "counterexample").when(F.lower(F.trim(F.coalesce(verdict, F.lit("")))) == "fail", "failed")
    )
