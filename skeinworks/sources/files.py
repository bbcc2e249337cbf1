"""Scans and sinks: tables by extension, JSON lines, trees of JSON files, catalogues, id lists, shards."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinworks.operators.relational import conform, dense_id, keep_first

SEED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("problem", "solution", "level", "subject")])


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A .parquet or .csv (with header) table; any other extension is an error."""
    reader = spark.read.schema(schema) if schema else spark.read
    if path.endswith(".parquet"):
        return reader.parquet(path)
    if path.endswith(".csv"):
        return reader.csv(path, header=True, multiLine=True, escape='"')
    raise ValueError(f"unsupported extension: {path}")


def save_table(df: DataFrame, path: str, mode: str = "error") -> None:
    """The same extensions as a sink. Nothing is overwritten unless mode says so."""
    if path.endswith(".parquet"):
        df.write.mode(mode).parquet(path)
    elif path.endswith(".csv"):
        df.write.mode(mode).csv(path, header=True, escape='"')
    else:
        raise ValueError(f"unsupported extension: {path}")


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """One object a line under a fixed schema; blank lines are skipped, a bad line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_with_provenance(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Rows of all files with source_file, the name without folders; lines that are no objects are left out."""
    bad = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    rows = spark.read.schema(bad).option("columnNameOfCorruptRecord", "__bad").json(paths)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return rows.withColumn("source_file", name).filter(F.col("__bad").isNull()).drop("__bad")


def read_seed_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """problem, solution, level, subject (given as type); what is missing is ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("problem", "solution", "level", "type", "subject")])
    rows = read_jsonl(spark, paths, schema).withColumn("subject", F.coalesce("type", "subject"))
    return conform(rows, SEED_SCHEMA, {c: "" for c in SEED_SCHEMA.names})


def read_json_tree(spark: SparkSession, root: str) -> DataFrame:
    """One object a file, in any depth; unreadable files are skipped; the subject falls back to the folder's name."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("problem", "solution", "level", "type", "subject", "__bad")])
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("multiLine", True).option("columnNameOfCorruptRecord", "__bad").json(root)
    folder = F.element_at(F.split(F.input_file_name(), "/"), -2)
    rows = rows.withColumn("subject", F.coalesce("type", "subject", folder)).filter(F.col("__bad").isNull())
    return conform(rows, SEED_SCHEMA, {c: "" for c in SEED_SCHEMA.names})


def read_ordered_json(spark: SparkSession, root: str) -> DataFrame:
    """position, folder, file and problem in the order of folder, first number in the file's name, name; blank problems are left out."""
    schema = T.StructType([T.StructField("problem", T.StringType()), T.StructField("level", T.StringType())])
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("multiLine", True).option("mode", "FAILFAST").json(root)
    parts = F.split(F.input_file_name(), "/")
    named = rows.select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("file"), "problem", "level").filter(F.trim("problem") != "")
    named = named.withColumn("number", F.coalesce(F.regexp_extract("file", "([0-9]+)", 1).try_cast("long"), F.lit(10**9)))
    return dense_id(named, ["folder", "number", "file"]).drop("number")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """code, l1, desc of full codes, once each, l1 with its leading zero; an empty result is an error."""
    rows = load_table(spark, path)
    missing = {"code", "l1", "desc"} - set(rows.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    good = rows.filter(F.col("code").rlike("^[0-9]{2}[A-Z][0-9]{2}$")).groupBy("code").agg(F.min(F.struct(F.lpad("l1", 2, "0").alias("l1"), "desc")).alias("r")).select("code", "r.l1", "r.desc")
    if good.isEmpty():
        raise ValueError(f"no full code in {path}")
    return good


def parse_outline(lines: DataFrame, column: str = "value") -> DataFrame:
    """level, code, desc of outline lines: '11-XX text', '11Axx text', '11A05 text'; the first form that fits counts."""
    c = F.trim(column)
    forms = (("l1", r"^([0-9]{2})-XX\s+(.+)$"), ("l2", r"^([0-9]{2}[A-Z]xx)\s+(.+)$"), ("full", r"^([0-9]{2}[A-Z][0-9]{2})\s+(.+)$"))
    level = code = desc = None
    for name, pattern in forms:
        hit = c.rlike(pattern)
        level = F.when(hit, name) if level is None else level.when(hit, name)
        code = F.when(hit, F.regexp_extract(c, pattern, 1)) if code is None else code.when(hit, F.regexp_extract(c, pattern, 1))
        desc = F.when(hit, F.regexp_extract(c, pattern, 2)) if desc is None else desc.when(hit, F.regexp_extract(c, pattern, 2))
    return lines.select(level.alias("level"), code.alias("code"), desc.alias("desc")).filter("level is not null")


def outline_catalogue(lines: DataFrame, column: str = "value") -> DataFrame:
    """code, l1, l2, desc, l1_desc, l2_desc of an outline's full codes, each with the headings above it ('' where one is missing)."""
    rows = parse_outline(lines, column).groupBy("level", "code").agg(F.min("desc").alias("desc"))
    of = lambda level: rows.filter(F.col("level") == level)
    full = of("full").select("code", F.substring("code", 1, 2).alias("l1"), F.concat(F.substring("code", 1, 3), F.lit("xx")).alias("l2"), "desc")
    for k in ("l1", "l2"):
        full = full.join(of(k).select(F.col("code").alias(k), F.col("desc").alias(f"{k}_desc")), k, "left")
    return full.select("code", "l1", "l2", "desc", *(F.coalesce(f"{k}_desc", F.lit("")).alias(f"{k}_desc") for k in ("l1", "l2")))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One id a line, blank lines left out."""
    return spark.read.text(path).select(F.trim("value").alias("id")).filter("id <> ''").distinct()


def write_shards(df: DataFrame, order: list[str], path: str, rows: int = 100, prefix: str = "shard", exact: bool = True, mode: str = "error") -> None:
    """Folders shard=prefix_00001, ... of rows rows each, in a total order; with exact, a rest is an error."""
    n = df.count()
    if exact and n % rows:
        raise ValueError(f"{n} rows do not fill shards of {rows}")
    numbered = dense_id(df, order, "__n")
    named = numbered.withColumn("shard", F.format_string(f"{prefix}_%05d", F.floor(F.col("__n") / rows) + 1))
    named.drop("__n").repartition("shard").write.mode(mode).partitionBy("shard").option("ignoreNullFields", False).json(path)


def read_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """code, desc of a catalogue: codes in upper case and trimmed, blank descriptions left out, each code's first row in the order of its descriptions' lines.

    A missing file gives an empty frame, as descriptions are an extra.
    """
    try:
        rows = spark.read.option("header", True).csv(path)
    except AnalysisException:
        return spark.createDataFrame([], "code string, desc string")
    clean = rows.select(F.upper(F.trim("code")).alias("code"), F.trim("desc").alias("desc"), F.monotonically_increasing_id().alias("__line"))
    return keep_first(clean.filter("code <> '' and desc <> ''"), ["code"], [F.col("__line")]).drop("__line")


def append_rolling(df: DataFrame, order: list[str], path: str, rows: int = 100, prefix: str = "shard") -> int:
    """Append rows to folders shard=prefix_00001, ... of rows rows each, filling up the last one first; gives the rows now there."""
    try:
        done = df.sparkSession.read.json(path).count()
    except AnalysisException:
        done = 0
    numbered = dense_id(df, order, "__n").withColumn("shard", F.format_string(f"{prefix}_%05d", F.floor((F.col("__n") + done) / rows) + 1))
    numbered.drop("__n").repartition("shard").write.mode("append").partitionBy("shard").option("ignoreNullFields", False).json(path)
    return done + df.count()
