"""Lines, lists, families and reports against the rules for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.functions import validate as V
from skeinworks.plans.answers import ONE_SQL, first_deliveries
from skeinworks.plans.registry import query
from skeinworks.plans.texts import norm_sql
from skeinworks.runtime import table

_WEAK = "|".join([*V.WEAK_PHRASES, *V.PLACEHOLDERS])
_LATENT = "|".join([*V.WEAK_PHRASES, *V.PLACEHOLDERS, *V.GENERIC_PHRASES])


def _line_sql(c: str, pattern: str) -> str:
    return f"CASE WHEN trim({norm_sql(c)}) = '' THEN 'missing' WHEN regexp_matches({norm_sql(c)}, '{pattern}') THEN 'underspecified' END"


@query(
    "line_errors",
    f"""WITH {ONE_SQL}, l AS (SELECT *, list_filter(solution_steps, lambda x: trim({norm_sql('x')}) <> '') AS lines, 'Under ' || coalesce(key_idea, '') AS latent FROM t)
    SELECT answer_id, {_line_sql('key_idea', _WEAK)} AS idea, CASE WHEN solution_steps IS NULL THEN 'invalid' WHEN len(lines) < 2 THEN 'too_short' WHEN len(list_filter(lines, lambda x: regexp_matches({norm_sql('x')}, '{_WEAK}'))) > 0 THEN 'underspecified' END AS steps,
    {_line_sql("latent || ' given  conditions'", _LATENT)} AS vague FROM l""",
)
def line_errors(spark, sf_dir: str) -> DataFrame:
    """Ideas and steps of answers held against the rules for lines and lists; a vague line is told as such."""
    a = first_deliveries(table(spark, sf_dir, "answered_rows"))
    vague = F.concat(F.lit("Under "), F.coalesce("key_idea", F.lit("")), F.lit(" given  conditions"))
    return a.select("answer_id", V.line_error(F.col("key_idea")).alias("idea"), V.list_error(F.col("solution_steps"), 2).alias("steps"), V.line_error(vague, True).alias("vague"))


_FAMILY_SQL = "CASE " + " ".join(f"WHEN regexp_matches(p, '{'|'.join(words)}') THEN '{name}'" for name, words in V.FAMILIES.items()) + f" ELSE '{V.OTHER_FAMILY}' END"


@query("problem_families", f"SELECT family, lower(trim(coalesce(problem_family, ''))) AS given, count(*) AS n FROM (SELECT problem_family, {_FAMILY_SQL} AS family FROM (SELECT problem_family, {norm_sql('problem')} AS p FROM synth_refill)) GROUP BY ALL")
def problem_families(spark, sf_dir: str) -> DataFrame:
    """Families told by a problem's words against those given with it."""
    s = table(spark, sf_dir, "synth_refill")
    return s.groupBy(V.problem_family(F.col("problem")).alias("family"), F.lower(F.trim(F.coalesce("problem_family", F.lit("")))).alias("given")).agg(F.count("*").alias("n"))


@query("truth_reports", f"WITH {ONE_SQL} SELECT answer_id, CASE WHEN f = 'wrong problem' THEN 'not_well_posed' WHEN coalesce(trim(answer_check), '') = '' THEN 'unsound' WHEN len(steps) >= 5 AND answer_finish_reason = 'length' THEN 'counterexample' WHEN lower(v) = 'fail' THEN 'failed' END AS error FROM t")
def truth_reports(spark, sf_dir: str) -> DataFrame:
    """Reports on answers: a problem that is wrong is not well posed, one without a check unsound, and so on."""
    a = first_deliveries(table(spark, sf_dir, "answered_rows"))
    from skeinworks.functions.answers import kept_steps
    from skeinworks.functions.text import squeeze_ends

    text = lambda c: squeeze_ends(F.coalesce(c, F.lit("")))
    error = V.report_error(text("final_answer") != "wrong problem", F.trim("answer_check") != "", F.col("answer_finish_reason") == "length", text("verdict"), F.size(kept_steps(F.col("solution_steps"))) >= 5)
    return a.select("answer_id", error.alias("error"))
