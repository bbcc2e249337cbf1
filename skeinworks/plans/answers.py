"""Answer rows: token counts, routing, checks, and the richer one of several."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.functions import answers as A
from skeinworks.functions import text as T
from skeinworks.operators import relational as R
from skeinworks.plans.registry import query
from skeinworks.runtime import table

E = r"[\s\p{Z}\x0b\x{85}\x{1c}-\x{1f}]"


def _text(c: str) -> str:
    return rf"regexp_replace(coalesce({c}, ''), '^{E}+|{E}+$', '', 'g')"


STEPS_SQL = rf"list_filter(list_transform(coalesce(solution_steps, []), lambda s: regexp_replace(regexp_replace(coalesce(s, ''), '(?i)^[\s]*(step|步骤)\s*[0-9]+\s*[:.：、)]?\s*', ''), '^{E}+|{E}+$', '', 'g')), lambda s: s <> '')"
ONE_SQL = f"""one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY answer_id ORDER BY arrived_at, source_file) AS delivery FROM answered_rows) WHERE delivery = 1),
a AS (SELECT *, {STEPS_SQL} AS steps, {_text('final_answer')} AS f, {_text('key_idea')} AS i, {_text('verdict')} AS v,
  length(coalesce(key_idea, '')) + length(coalesce(final_answer, '')) + coalesce(list_sum(list_transform(solution_steps, lambda s: length(coalesce(s, '')))), 0) AS raw_length, length(coalesce(final_answer, '')) AS flen FROM one),
u AS (SELECT *, CASE answer_finish_reason WHEN 'length' THEN json_object('completion_tokens_details', json_object('text_tokens', flen), 'output_tokens', 7) WHEN 'stop' THEN json_object('output_tokens', CAST(flen AS VARCHAR)) ELSE json_object('completion_tokens_details', json_object('text_tokens', 0), 'completion_tokens', flen) END AS usage FROM a),
t AS (SELECT *, coalesce(CASE WHEN try_cast(json_extract_string(usage, '$.completion_tokens_details.text_tokens') AS BIGINT) > 0 THEN try_cast(json_extract_string(usage, '$.completion_tokens_details.text_tokens') AS BIGINT) END,
  try_cast(json_extract_string(usage, '$.output_tokens') AS BIGINT), try_cast(json_extract_string(usage, '$.completion_tokens') AS BIGINT), 0) AS tokens FROM u)
"""


def first_deliveries(rows: DataFrame, key: str = "answer_id") -> DataFrame:
    """Each key's row that arrived first."""
    return R.keep_first(rows, [key], [F.col("arrived_at"), F.col("source_file")])


def _measured(spark, sf_dir: str) -> DataFrame:
    """Answers once each, with raw_length and a usage object (JSON) of the kinds that clients return, and its tokens."""
    a = first_deliveries(table(spark, sf_dir, "answered_rows"))
    n = lambda c: F.length(F.coalesce(c, F.lit("")))
    inner = F.aggregate(F.coalesce("solution_steps", F.array().cast("array<string>")), F.lit(0), lambda s, x: s + F.length(F.coalesce(x, F.lit(""))))
    size = n("final_answer")
    details = lambda x: F.struct(x.alias("text_tokens"))
    usage = (
        F.when(F.col("answer_finish_reason") == "length", F.to_json(F.struct(details(size).alias("completion_tokens_details"), F.lit(7).alias("output_tokens"))))
        .when(F.col("answer_finish_reason") == "stop", F.to_json(F.struct(size.cast("string").alias("output_tokens"))))
        .otherwise(F.to_json(F.struct(details(F.lit(0)).alias("completion_tokens_details"), size.alias("completion_tokens"))))
    )
    a = a.withColumn("raw_length", (n("key_idea") + n("final_answer") + inner).cast("long")).withColumn("usage", usage)
    return a.withColumn("tokens", A.completion_tokens(F.col("usage")))


@query("first_deliveries", "SELECT answer_id, source_file, epoch_us(arrived_at) AS arrived_us FROM (SELECT *, row_number() OVER (PARTITION BY answer_id ORDER BY arrived_at, source_file) AS r FROM answered_rows) WHERE r = 1")
def first_deliveries_query(spark, sf_dir: str) -> DataFrame:
    """Answers delivered twice, once each: the delivery that arrived first."""
    return first_deliveries(table(spark, sf_dir, "answered_rows")).select("answer_id", "source_file", F.unix_micros("arrived_at").alias("arrived_us"))


@query("answer_normal", f"WITH {ONE_SQL} SELECT answer_id, CASE WHEN w THEN 'wrong_problem' ELSE 'ok' END AS verdict, CASE WHEN w THEN '' ELSE i END AS idea, array_to_string(CASE WHEN w THEN CASE WHEN len(steps) > 0 THEN steps[1:1] ELSE ['{A.NO_REASON}'] END ELSE steps[1:8] END, chr(10)) AS steps, CASE WHEN w THEN 'wrong problem' ELSE f END AS final, CASE WHEN w THEN NULL WHEN f = '' THEN 'empty_final_answer' WHEN len(steps) = 0 THEN 'empty_solution_steps' WHEN i = '' THEN 'empty_key_idea' WHEN len(steps) < 5 THEN 'too_few_solution_steps' END AS error FROM (SELECT *, f = 'wrong problem' OR v = 'wrong_problem' AS w FROM t)")
def answer_normal(spark, sf_dir: str) -> DataFrame:
    """Answers in the form in which they are kept, with what is wrong with them."""
    a = first_deliveries(table(spark, sf_dir, "answered_rows"))
    got = A.normal_answer(F.col("verdict"), F.col("key_idea"), F.col("solution_steps"), F.col("final_answer"))
    return a.select("answer_id", got.alias("x")).select("answer_id", "x.verdict", "x.idea", F.array_join("x.steps", "\n").alias("steps"), "x.final", "x.error")


@query("answer_tokens", f"WITH {ONE_SQL} SELECT answer_id, raw_length::BIGINT AS raw_length, tokens::BIGINT AS tokens FROM t")
def answer_tokens(spark, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir).select("answer_id", "raw_length", "tokens")


@query("answer_routing", f"""WITH {ONE_SQL}, d AS (SELECT t.*, lower(trim(coalesce(s.difficulty, ''))) AS level FROM t LEFT JOIN (SELECT synth_id, any_value(difficulty) AS difficulty FROM synth_refill GROUP BY synth_id) s USING (synth_id)),
r AS (SELECT *, CASE level WHEN 'easy' THEN 'small' WHEN 'hard' THEN 'large' ELSE 'standard' END AS model, CASE level WHEN 'easy' THEN 2048 WHEN 'hard' THEN 8192 ELSE 4096 END AS most_tokens, CASE level WHEN 'easy' THEN 3 WHEN 'hard' THEN 9 ELSE 6 END AS least_tokens FROM d)
SELECT answer_id, model, most_tokens::INT AS most_tokens, least_tokens::INT AS least_tokens, v = 'ok' AND (raw_length < greatest(200, least_tokens * 4) OR tokens > 0 AND tokens < greatest(1, least_tokens)) AS too_short FROM r""")
def answer_routing(spark, sf_dir: str) -> DataFrame:
    """The model and token bounds of each answer by its problem's difficulty, and whether the answer is too short for them."""
    level = table(spark, sf_dir, "synth_refill").select("synth_id", "difficulty")
    a = _measured(spark, sf_dir).join(level, "synth_id", "left")
    d = F.col("difficulty")
    a = a.withColumn("model", A.routed(d, "small", "standard", "large")).withColumn("most_tokens", A.routed(d, 2048, 4096, 8192)).withColumn("least_tokens", A.routed(d, 3, 6, 9))
    short = A.too_short(T.squeeze_ends(F.coalesce("verdict", F.lit(""))), F.col("raw_length"), F.col("tokens"), F.col("least_tokens"), 200)
    return a.select("answer_id", "model", "most_tokens", "least_tokens", short.alias("too_short"))


@query("answer_repair", f"WITH {ONE_SQL} SELECT source_file, answer_id, raw_length::BIGINT AS raw_length, tokens::BIGINT AS tokens, len(steps)::INT AS steps, candidates FROM (SELECT *, count(*) OVER (PARTITION BY source_file) AS candidates, row_number() OVER (PARTITION BY source_file ORDER BY raw_length DESC, tokens DESC, len(steps) DESC, answer_id DESC) AS r FROM t WHERE source_file IS NOT NULL) WHERE r = 1 AND candidates > 1")
def answer_repair(spark, sf_dir: str) -> DataFrame:
    """Of a file's answers the richest, by characters, tokens and steps in this order; of equals the later one."""
    a = _measured(spark, sf_dir).filter("source_file is not null").withColumn("n", F.size(A.kept_steps(F.col("solution_steps"))))
    rich = F.struct(A.richness(F.col("raw_length"), F.col("tokens"), F.col("n")), F.col("answer_id"))
    best = a.groupBy("source_file").agg(F.max_by(F.struct("answer_id", "raw_length", "tokens", F.col("n").alias("steps")), rich).alias("b"), F.count("*").alias("candidates")).filter("candidates > 1")
    return best.select("source_file", "b.answer_id", "b.raw_length", "b.tokens", "b.steps", "candidates")


@query("message_texts", "SELECT qid, concat_ws(chr(10), problem, answer) AS list_text, coalesce(answer, '') AS one_text, coalesce(problem, '') AS plain FROM math_seed")
def message_texts(spark, sf_dir: str) -> DataFrame:
    """Messages as lists of parts, as one part and as plain text, flattened."""
    s = table(spark, sf_dir, "math_seed")
    part = lambda c: F.struct(F.col(c).alias("text"))
    return s.select("qid", A.message_text(F.to_json(F.array(part("problem"), part("answer")))).alias("list_text"), A.message_text(F.to_json(part("answer"))).alias("one_text"), A.message_text(F.col("problem")).alias("plain"))


@query("bool_flags", "SELECT DISTINCT answer_id, CASE WHEN x IN ('true', '1', 'yes', 'y', '1.0') THEN true WHEN x IN ('false', '0', 'no', 'n', '0.0', '') THEN false ELSE false END AS flag FROM (SELECT answer_id, lower(trim(final_answer)) AS x FROM answered_rows)")
def bool_flags(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "answered_rows").select("answer_id", T.to_bool(F.col("final_answer")).alias("flag")).distinct()


NORM = rf"regexp_replace(regexp_replace(regexp_replace(lower(coalesce(%s, '')), '{E}+', ' ', 'g'), '^ | $', '', 'g'), '[`*_]', '', 'g')"


@query("answer_matches", f"WITH {ONE_SQL}, m AS (SELECT answer_id, {NORM % 'final_answer'} AS x, {NORM % 'last'} AS y FROM (SELECT *, coalesce(regexp_extract_all(answer_check, '[0-9]+([.][0-9]+)?')[-1], '') AS last FROM t)) SELECT answer_id, x = y OR coalesce(abs(try_cast(x AS DOUBLE) - try_cast(y AS DOUBLE)) <= 0.000001, false) AS matches FROM m")
def answer_matches(spark, sf_dir: str) -> DataFrame:
    """Whether the final answer equals the last number of the check."""
    a = first_deliveries(table(spark, sf_dir, "answered_rows"))
    last = F.coalesce(F.try_element_at(F.regexp_extract_all("answer_check", F.lit(r"[0-9]+([.][0-9]+)?"), F.lit(0)), F.lit(-1)), F.lit(""))
    return a.select("answer_id", T.answers_match(F.col("final_answer"), last).alias("matches"))
