"""Text, level and JSON functions as column expressions; everything stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python and Unicode see it.
SPACE = r"[\s\p{Z}\x0b\x{85}\x{1c}-\x{1f}]"


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank; none is left at the ends."""
    return F.regexp_replace(F.regexp_replace(c, f"{SPACE}+", " "), "^ | $", "")


def normalize_text(c: Column) -> Column:
    """Null gives ''; lower case, white space squeezed, and only then ` * _ deleted, which may leave double blanks."""
    return F.regexp_replace(squeeze(F.lower(F.coalesce(c, F.lit("")))), "[`*_]", "")


def boxed_answer(c: Column) -> Column:
    r"""The last \boxed{...} without inner braces, trimmed; '' if there is none."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\\boxed\{([^{}]+)\}"), F.lit(1))
    return F.when(F.size(found) > 0, squeeze_ends(F.element_at(found, -1))).otherwise(F.lit(""))


def squeeze_ends(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def level_to_y(c: Column, default: float | None = 0.5) -> Column:
    """(d - 1) / 4 of the first digit 1..5; else the default, or null."""
    y = (F.regexp_extract(F.lower(c), "([1-5])", 1).try_cast("double") - 1) / 4
    return F.coalesce(y, F.lit(default)) if default is not None else y


def level_number(c: Column) -> Column:
    """The first run of digits as a number, 0 if there is none."""
    return F.coalesce(F.regexp_extract(c, r"([0-9]+)", 1).try_cast("int"), F.lit(0))


def level_to_difficulty(c: Column) -> Column:
    """easy up to 2, medium at 3 (also without a digit), else hard."""
    n = F.coalesce(F.regexp_extract(c, "([1-5])", 1).try_cast("int"), F.lit(3))
    return F.when(n <= 2, "easy").when(n == 3, "medium").otherwise("hard")


def subject_code(c: Column) -> Column:
    """The first two digits, a letter, two digits; '' if there is none."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"([0-9]{2}[A-Z][0-9]{2})", 1)


def tokens(c: Column) -> Column:
    """All runs of a-z and 0-9 of the normalised text, in order."""
    return F.regexp_extract_all(normalize_text(c), F.lit("[a-z0-9]+"), F.lit(0))


# Words that say nothing about a seed's content.
SEED_STOP = "the that with from between prove find show determine compute classify integer integers number numbers given such have has are".split()


def seed_tokens(c: Column) -> Column:
    """Distinct words of at least two characters; backslashes stay with their word, stop words go."""
    words = F.split(F.regexp_replace(normalize_text(c), r"[^a-z0-9\\s]", " "), " ")
    keep = F.filter(words, lambda w: (F.length(w) >= 2) & ~w.isin(SEED_STOP))
    return F.array_distinct(keep)


def digit_runs(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[0-9]+"), F.lit(0)))


def phrases(c: Column) -> Column:
    """Distinct phrases between bars: letters, digits and blanks in lower case."""
    clean = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}| ]", " ")
    return F.array_distinct(F.filter(F.transform(F.split(clean, r"\|"), squeeze), lambda p: p != ""))


def short(c: Column, n: int) -> Column:
    """The trimmed text, cut to n characters with ... if it is longer."""
    t = squeeze_ends(F.coalesce(c, F.lit("")))
    return F.when(F.length(t) <= n, t).otherwise(F.concat(F.substring(t, 1, n - 3), F.lit("...")))


# Patterns of relations in a statement; overlapping ones add up.
RELATIONS = (r"\\le", r"\\ge", "≤", "≥", r"\\equiv", r"\\mid", "=", "<", ">")


def relation_count(c: Column) -> Column:
    total = F.lit(0)
    for p in RELATIONS:
        total = total + F.regexp_count(F.coalesce(c, F.lit("")), F.lit(p))
    return total


# Words that open a statement's question.
QUERY_VERBS = "find|determine|compute|calculate|evaluate|identify|what is|求|求出|计算|确定|判断|证明"


def body_skeleton(c: Column) -> Column:
    """The text before its last query verb, normalised, numbers as N and single letters with an index as v."""
    raw = F.coalesce(c, F.lit(""))
    head = F.regexp_extract(raw, rf"(?is)^(.*)\b({QUERY_VERBS})\b", 1)
    body = normalize_text(F.when(raw.rlike(rf"(?is)\b({QUERY_VERBS})\b"), head).otherwise(raw))
    body = F.regexp_replace(body, r"\b[0-9]+\b", "N")
    body = F.regexp_replace(body, r"\b[a-z][0-9]*\b", "v")
    return F.trim(F.regexp_replace(body, " +", " "))


def strip_step_label(c: Column) -> Column:
    return squeeze_ends(F.regexp_replace(c, r"(?i)^[\s]*(step|步骤)\s*[0-9]+\s*[:.：、)]?\s*", ""))


def render_steps(steps: Column) -> Column:
    """Steps as numbered lines."""
    return F.array_join(F.transform(steps, lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), F.coalesce(s, F.lit("")))), "\n")


_NUMBERS = "real|positive real|nonnegative real|non-negative real|integer|positive integer|nonnegative integer|non-negative integer|complex"
_SYMBOLS = r"((?:[A-Za-z]\w*\s*(?:,\s*[A-Za-z]\w*\s*)+))"
# Forms in which several symbols are declared at once, or one gets a value.
DECLARED = (rf"\b(?:{_NUMBERS})(?:\s+numbers?)?\s+{_SYMBOLS}", rf"\blet\s+{_SYMBOLS}\s+be\s+(?:{_NUMBERS})(?:\s+numbers?)?\b")
ASSIGNED = r"\b([A-Za-z]\w*)\s*="


def declared_symbols(c: Column) -> Column:
    """Distinct symbols of all lists that declare several at once."""
    t = F.coalesce(c, F.lit(""))
    lists = F.concat(*(F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in DECLARED))
    names = F.flatten(F.transform(lists, lambda x: F.split(x, ",")))
    return F.array_distinct(F.filter(F.transform(names, squeeze_ends), lambda x: x != ""))


def assigned_symbols(c: Column) -> Column:
    """Distinct symbols in front of an equals sign."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(ASSIGNED), F.lit(1)))


def to_bool(c: Column, default: bool = False) -> Column:
    """Truth words and numbers as a boolean."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("true", "1", "yes", "y", "1.0"), True).when(t.isin("false", "0", "no", "n", "0.0", ""), False).otherwise(F.lit(default))


def tagged_question(c: Column) -> Column:
    """The body of the first <Q>...</Q>, or the whole text, trimmed."""
    body = squeeze_ends(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?is)<Q>(.*?)</Q>", 1))
    return F.when(body != "", body).otherwise(squeeze_ends(F.coalesce(c, F.lit(""))))


def answers_match(a: Column, b: Column, eps: float = 1e-6) -> Column:
    """Equal after normalisation, or equal numbers within eps; no expression is ever evaluated."""
    x, y = normalize_text(a), normalize_text(b)
    return (x == y) | F.coalesce(F.abs(x.try_cast("double") - y.try_cast("double")) <= eps, F.lit(False))


def clip01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def chain_difficulty(node: Column, confs: Column, switches: Column, length: Column) -> Column:
    """0.55 node + 0.15 length + 0.15 jump + 0.15 crossing, clipped; null for chains of fewer than two nodes."""
    jump = F.when(F.size(confs) > 0, F.aggregate(confs, F.lit(0.0), lambda s, x: s + 1 - F.coalesce(x, F.lit(0.0))) / F.size(confs)).otherwise(0.5)
    raw = 0.55 * node + 0.15 * clip01((length - 2) / F.lit(2.0)) + 0.15 * jump + 0.15 * switches / (length - 1)
    return F.when(length >= 2, clip01(raw))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all entries of two arrays of distinct values, 0 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every > 0, both / every).otherwise(0.0)


def scale_widths(c: Column, lo: Column, hi: Column, least: float, most: float) -> Column:
    """Min-max scaling of log1p values into [least, most]; the middle if all are equal."""
    v = F.log1p(F.greatest(F.coalesce(c.cast("double"), F.lit(0.0)), F.lit(0.0)))
    return F.when(hi - lo < 1e-12, (least + most) / 2).otherwise(least + (v - lo) / (hi - lo) * (most - least))


def prompt_cut(c: Column, n: int) -> Column:
    """The first n characters, '' for null."""
    return F.substring(F.coalesce(c, F.lit("")), 1, n)


def numeric_goal_with_free_symbols(c: Column, numeric: str, open_: str) -> Column:
    """Whether a number is asked for, nothing in the text admits more answers, and two or more declared symbols have no value."""
    t = normalize_text(c)
    declared = declared_symbols(c)
    return t.rlike(numeric) & ~t.rlike(open_) & (F.size(declared) >= 2) & (F.size(F.array_except(declared, assigned_symbols(c))) >= 2)


def target_given(target: Column, clauses: Column) -> Column:
    """Whether a target of at least six characters is, or stands in, one of the clauses."""
    return (F.length(target) >= 6) & F.exists(clauses, lambda x: x.contains(target))
