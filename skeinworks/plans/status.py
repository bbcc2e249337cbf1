"""Run status as a table: attempts, stages and the last errors, instead of a document rewritten in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.operators.relational import top_k
from skeinworks.plans.registry import query
from skeinworks.runtime import table


def stage_summary(log: DataFrame) -> DataFrame:
    """stage, state, n, mean_s, least_s, most_s of stage rows (stage, state, duration_s)."""
    return log.groupBy("stage", "state").agg(F.count("*").alias("n"), F.avg("duration_s").alias("mean_s"), F.min("duration_s").alias("least_s"), F.max("duration_s").alias("most_s"))


def last_errors(log: DataFrame, by: list[str], k: int = 20) -> DataFrame:
    """The k latest rows with an error of each group (at, id, error)."""
    return top_k(log.filter("error is not null"), by, [F.col("at").desc(), F.col("id").desc()], k)


@query(
    "manifest_check",
    """WITH a AS (SELECT source_file AS file_name, count(*) AS delivered, count(DISTINCT answer_id) AS answers, count(DISTINCT answer_id) FILTER (WHERE lower(trim(verdict)) = 'fail') AS fails FROM answered_rows GROUP BY source_file)
    SELECT file_name, total_rows, map_extract_value(verdict_counts, 'fail') AS claimed, coalesce(delivered, 0) AS delivered, coalesce(answers, 0) AS answers, coalesce(fails, 0) AS fails FROM manifest LEFT JOIN a USING (file_name)""",
)
def manifest_check(spark, sf_dir: str) -> DataFrame:
    """Each file's manifest against the rows that came."""
    a = table(spark, sf_dir, "answered_rows")
    fail = F.lower(F.trim("verdict")) == "fail"
    per = a.groupBy(F.col("source_file").alias("file_name")).agg(F.count("*").alias("delivered"), F.countDistinct("answer_id").alias("answers"), F.countDistinct(F.when(fail, F.col("answer_id"))).alias("fails"))
    m = table(spark, sf_dir, "manifest").select("file_name", "total_rows", F.try_element_at("verdict_counts", F.lit("fail")).alias("claimed"))
    return m.join(per, "file_name", "left").fillna(0, ["delivered", "answers", "fails"])


@query("late_rows", "SELECT answer_model, count(*) AS rows_all, count(*) FILTER (WHERE arrived_at - answered_at > INTERVAL 1 DAY) AS late FROM answered_rows GROUP BY answer_model")
def late_rows(spark, sf_dir: str) -> DataFrame:
    """Rows of each model that arrived more than a day late."""
    a = table(spark, sf_dir, "answered_rows")
    late = F.col("arrived_at") - F.col("answered_at") > F.expr("INTERVAL '1' DAY")
    return a.groupBy("answer_model").agg(F.count("*").alias("rows_all"), F.count_if(late).alias("late"))


@query("last_failures", "SELECT source_file, answer_id, rank::INT AS rank FROM (SELECT source_file, answer_id, row_number() OVER (PARTITION BY source_file ORDER BY answered_at DESC, answer_id DESC) AS rank FROM (SELECT DISTINCT source_file, answer_id, answered_at FROM answered_rows WHERE lower(trim(verdict)) = 'fail')) WHERE rank <= 20")
def last_failures(spark, sf_dir: str) -> DataFrame:
    """The twenty latest failed answers of each file (a top-k report)."""
    a = table(spark, sf_dir, "answered_rows").filter(F.lower(F.trim("verdict")) == "fail").select("source_file", "answer_id", "answered_at").distinct()
    log = a.select("source_file", F.col("answer_id").alias("id"), F.col("answered_at").alias("at"), F.lit("fail").alias("error"))
    return last_errors(log, ["source_file"]).select("source_file", F.col("id").alias("answer_id"), "rank")


@query("edge_judgement")
def edge_judgement(spark, sf_dir: str) -> DataFrame:
    """Votes of the stand-in judge on every chain edge: share, mean confidence, blend and decision."""
    from skeinworks.plans.graphs import chain_edges
    from skeinworks.sources.judge import StubJudge, votes

    e = chain_edges(spark, sf_dir)
    prompts = e.select(F.concat_ws(">", "src", "dst", "type").alias("id"), F.concat_ws(" ", F.lit("Does"), "src", F.lit("prepare"), "dst", F.lit("?")).alias("prompt"))
    v = votes(prompts, StubJudge)
    out = v.groupBy("id").agg(F.avg(F.col("allow").cast("double")).alias("share"), F.avg("confidence").alias("mean_conf"))
    return out.withColumn("blend", F.round(0.6 * F.col("share") + 0.4 * F.col("mean_conf"), 6)).withColumn("allow", (F.col("share") > 0.5) & (F.col("mean_conf") >= 0.3)).select("id", F.round("share", 6).alias("share"), F.round("mean_conf", 6).alias("mean_conf"), "blend", "allow")
