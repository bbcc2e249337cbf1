"""A sample with target shares of categories: controlled rounding by max-flow, exact random-key quotas.

For each plan the wanted rows of a category are spread over strata in proportion to its rows there. This
fractional table of categories by strata is made integer by a max-flow such that every cell and every
stratum's total is rounded up or down and every category's total is kept. In each cell exactly its quota of
rows with the smallest random keys is taken: a histogram of the keys' top bits finds the bucket where the
quota ends, and only that bucket's rows (some BUCKET_ROWS of the cell) are ranked, so no task ever
holds a category. Strata are taken as they are; only beyond MAX_STRATA of them do several share a column of the table, by hash,
and the margins kept are then those of such groups of strata. The quota of every category is exact in either case.

Defined results: categories are compared trimmed and in lower case, blank ones belong to none but count in
the total; a category with fewer rows than needed gives all of them and is reported as not met; equal keys
of repeated rows are taken in any order, being equal rows; an empty table gives an empty sample and
reports every category whose need is positive; extra columns are ignored. Plans are settings of at most
PLAN_ROWS rows.
"""

from __future__ import annotations

from collections import defaultdict, deque
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinworks import runtime
from skeinworks.llm.cooccurrence import trimmed

MAX_STRATA = 20_000
BUCKET_ROWS = 16
PLAN_ROWS = 10_000


def largest_remainder(shares: list[tuple[int, int]], total: int) -> list[int]:
    """Integers that sum to total, each floor or ceiling of num / den; ties go to the earlier."""
    base = [n // d for n, d in shares]
    by = sorted(range(len(shares)), key=lambda i: (-((shares[i][0] % shares[i][1]) / shares[i][1]), i))
    for i in by[: max(0, total - sum(base))]:
        base[i] += 1 if shares[i][0] % shares[i][1] else 0
    return base


def controlled_rounding(quota: list[int], counts: list[list[int]]) -> list[list[int]]:
    """Integer cells near quota[i] * counts[i][j] / sum(counts[i]), rows exact, columns rounded up or down.

    The fractional table itself is a flow between these bounds, so an integer one exists; it is found by
    augmenting paths, first up to each column's lower bound, then up to its upper bound, from a flow that gives each column
    to the rows with most left to place.
    """
    rows, cols = len(quota), len(counts[0]) if counts else 0
    total = [sum(r) for r in counts]
    cell = [[quota[i] * c // total[i] if total[i] else 0 for c in counts[i]] for i in range(rows)]
    open_ = [[bool(total[i]) and quota[i] * c % total[i] > 0 for c in counts[i]] for i in range(rows)]
    supply = [quota[i] - sum(cell[i]) if total[i] else 0 for i in range(rows)]
    used = [[False] * cols for _ in range(rows)]
    taken = [0] * cols
    common = 1
    for t in total:
        common = common * t if t else common
    factor = [quota[i] * (common // total[i]) if total[i] else 0 for i in range(rows)]
    exact = [sum(f * counts[i][j] for i, f in enumerate(factor)) for j in range(cols)]
    below = [sum(cell[i][j] for i in range(rows)) for j in range(cols)]
    for upper in (False, True):
        limit = [(-(-exact[j] // common) if upper else exact[j] // common) - below[j] for j in range(cols)]
        for j in range(cols):
            for i in sorted((i for i in range(rows) if open_[i][j] and not used[i][j] and supply[i]), key=lambda i: -supply[i])[: max(0, limit[j] - taken[j])]:
                used[i][j] = True
                taken[j] += 1
                supply[i] -= 1
        for i in range(rows):
            while supply[i] and _augment(i, open_, used, taken, limit):
                supply[i] -= 1
    return [[cell[i][j] + used[i][j] for j in range(cols)] for i in range(rows)]


def _augment(start: int, open_: list[list[bool]], used: list[list[bool]], taken: list[int], limit: list[int]) -> bool:
    """One unit from a row to a column below its limit, along unused cells forward and used cells back."""
    row_of, column_of = {}, {start: None}  # how a column or row was reached
    todo = deque([start])
    while todo:
        i = todo.popleft()
        for j, free in enumerate(open_[i]):
            if not free or used[i][j] or j in row_of:
                continue
            row_of[j] = i
            if taken[j] < limit[j]:
                taken[j] += 1
                while j is not None:
                    i = row_of[j]
                    used[i][j] = True
                    j = column_of[i]
                    if j is not None:
                        used[i][j] = False
                return True
            for r in range(len(open_)):
                if used[r][j] and r not in column_of:
                    column_of[r] = j
                    todo.append(r)
    return False


@dataclass
class QuotaSample:
    """sample: plan_id, id, category. report: plan_id, category, target_pct, need, available, quota, drawn, met."""

    sample: DataFrame
    report: DataFrame


def quota_sample(records: DataFrame, plans: DataFrame, max_strata: int = MAX_STRATA, bucket_rows: int = BUCKET_ROWS, seed: int = 1) -> QuotaSample:
    """Draw every plan's sample from records (id bigint, category string, stratum of any type).

    plans: plan_id, category, target_pct int, min_rows bigint, sample_permille int. With R records and
    n = R * sample_permille div 1000, a category needs max(min_rows, n * target_pct div 100) rows.
    """
    spark = records.sparkSession
    rules = plans.select("plan_id", "category", "target_pct", "min_rows", "sample_permille").limit(PLAN_ROWS + 1).collect()
    if len(rules) > PLAN_ROWS:
        raise ValueError(f"more than {PLAN_ROWS} plan rows")
    clean = lambda c: trimmed(F.lower(c))
    names = plans.select(F.col("category").alias("named"), clean("category").alias("name")).distinct()
    key_of = {r[0]: r[1] for r in names.collect()}
    wanted = [k for k in {*key_of.values()} if k]
    name = clean("category")
    base = records.select("id", F.when(name.isin(wanted), name).alias("name") if wanted else F.lit(None).cast("string").alias("name"), F.coalesce(F.col("stratum").cast("string"), F.lit("")).alias("stratum"))
    counted = runtime.materialize(base.withColumn("stratum", F.when(F.col("name").isNotNull(), F.col("stratum"))).groupBy("name", "stratum").agg(F.count("*").alias("n")), "quota-cells")
    if counted.filter("name is not null").select("stratum").distinct().count() > max_strata:
        shared = F.pmod(F.xxhash64("stratum"), F.lit(max_strata)).cast("string")
        base, counted = (x.withColumn("stratum", F.when(F.col("name").isNotNull(), shared)) for x in (base, counted))
        counted = counted.groupBy("name", "stratum").agg(F.sum("n").alias("n"))
    cells: dict[str, dict[str, int]] = defaultdict(dict)
    total = 0
    for name, stratum, n in counted.collect():  # at most categories x max_strata
        total += n
        if name is not None:
            cells[name][stratum] = n
    strata = sorted({s for own in cells.values() for s in own})
    by_plan: dict[int, list] = defaultdict(list)
    for r in rules:
        by_plan[r[0]].append(r)
    quotas, report = [], []
    for plan, own in by_plan.items():
        own.sort(key=lambda r: str(r[1]))  # so that ties of remainders do not depend on the order of rows
        n = total * (own[0][4] or 0) // 1000
        shares = [(n * (r[2] or 0), 100) for r in own]
        even = largest_remainder(shares, -(-sum(s for s, _ in shares) // 100))
        table, want = [], []
        for r, e in zip(own, even):
            have = cells.get(key_of[r[1]], {})
            available = sum(have.values())
            need = max(r[3] or 0, n * (r[2] or 0) // 100)
            want.append(min(available, max(r[3] or 0, e)))
            table.append([have.get(s, 0) for s in strata])
            report.append((plan, r[1], r[2], need, available, want[-1]))
        for r, row in zip(own, controlled_rounding(want, table)):
            quotas += [(plan, r[1], key_of[r[1]], s, q) for s, q in zip(strata, row) if q]
    quota = spark.createDataFrame(quotas, "plan_id int, category string, name string, stratum string, quota long")
    # At most plan rows x strata: a bounded setting, as is everything joined to it below.
    drawn_from = sorted({(q[2], q[3]) for q in quotas})
    # So many key bits that a bucket of the cell holds bucket_rows rows or so; the quota ends in one of them.
    bits = spark.createDataFrame([(a, b, max(0, (cells[a][b] // bucket_rows).bit_length() - 1)) for a, b in drawn_from], "name string, stratum string, bits int")
    keyed = base.join(F.broadcast(bits), ["name", "stratum"]).withColumn("key", F.xxhash64(F.lit(seed), "id"))
    keyed = keyed.withColumn("bucket", F.expr("if(bits = 0, 0L, shiftrightunsigned(key, 64 - bits))")).drop("bits")
    histogram = keyed.groupBy("name", "stratum", "bucket").agg(F.count("*").alias("n"))
    run = Window.partitionBy("plan_id", "category", "stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cum = histogram.join(F.broadcast(quota), ["name", "stratum"]).withColumn("upto", F.sum("n").over(run))
    edge = cum.filter((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota"))).select("plan_id", "category", "name", "stratum", F.col("bucket").alias("edge"), (F.col("quota") - F.col("upto") + F.col("n")).alias("take"), "n")
    edge = runtime.materialize(edge, "quota-edges")
    near = keyed.join(F.broadcast(edge), ["name", "stratum"]).filter("bucket <= edge")
    whole = (F.col("bucket") < F.col("edge")) | (F.col("take") == F.col("n"))
    sure = near.filter(whole).select("plan_id", "id", "category")
    rank = F.row_number().over(Window.partitionBy("plan_id", "category", "stratum").orderBy("key", "id"))
    last = near.filter(~whole).withColumn("rank", rank).filter("rank <= take").select("plan_id", "id", "category")
    sample = sure.unionByName(last)
    drawn = sample.groupBy("plan_id", "category").agg(F.count("*").alias("drawn"))
    wanted_rows = spark.createDataFrame(report, "plan_id int, category string, target_pct int, need long, available long, quota long")
    full = wanted_rows.join(drawn, ["plan_id", "category"], "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)).cast("long"))
    return QuotaSample(sample, full.withColumn("met", F.col("drawn") >= F.col("need")))


RECORD_SETS = {"math_train": ("row_id", "difficulty", "shard_file"), "synth_refill": ("synth_id", "chain_bucket", "refill_file")}


def _on_tables(spark, sf_dir: str) -> dict[str, QuotaSample]:
    plans = runtime.table(spark, sf_dir, "quota_targets")
    out = {}
    for name, (i, category, stratum) in RECORD_SETS.items():
        records = runtime.table(spark, sf_dir, name).select(F.col(i).alias("id"), F.col(category).alias("category"), F.col(stratum).alias("stratum"))
        out[name] = quota_sample(records, plans.filter(F.col("record_set") == name))
    return out


def p2_found(spark, sf_dir: str) -> DataFrame:
    one, two = (s.report.filter("not met").select("plan_id", "category") for s in _on_tables(spark, sf_dir).values())
    return one.unionByName(two).distinct()


def p2_report(spark, sf_dir: str) -> DataFrame:
    """Need, supply and rows drawn of every category of every plan."""
    one, two = (s.report for s in _on_tables(spark, sf_dir).values())
    return one.unionByName(two).select("plan_id", "category", "target_pct", "need", "available", "drawn", "met")


def p2_sample(spark, sf_dir: str) -> DataFrame:
    """The rows drawn for every plan."""
    one, two = (s.sample.select("plan_id", F.lit(n).alias("record_set"), F.col("id").alias("record_id"), "category") for n, s in _on_tables(spark, sf_dir).items())
    return one.unionByName(two)


def p2_sample_checks(spark, sf_dir: str) -> DataFrame:
    """Of every plan and category: the rows drawn, how many different ones, and how many whose record has that category."""
    out, both = None, _on_tables(spark, sf_dir)
    for name, (i, category, _) in RECORD_SETS.items():
        records = runtime.table(spark, sf_dir, name).select(F.col(i).alias("id"), trimmed(F.lower(category)).alias("is"))
        got = both[name]
        rows = got.sample.join(records, "id").groupBy("plan_id", "category").agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids"), F.count_if(F.col("is") == trimmed(F.lower("category"))).alias("fitting"))
        rows = got.report.select("plan_id", "category").join(rows, ["plan_id", "category"], "left").fillna(0)
        out = rows if out is None else out.unionByName(rows)
    return out


_P2_SQL = r"""
WITH r AS (
  SELECT 'math_train' AS record_set, regexp_replace(lower(difficulty), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS c FROM math_train
  UNION ALL SELECT 'synth_refill', regexp_replace(lower(chain_bucket), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') FROM synth_refill),
n AS (SELECT record_set, count(*) AS rows_all FROM r GROUP BY record_set),
k AS (SELECT record_set, c, count(*) AS rows_c FROM r GROUP BY record_set, c),
t AS (SELECT q.plan_id, q.category, q.target_pct, greatest(q.min_rows, ((coalesce(rows_all, 0) * q.sample_permille) // 1000 * q.target_pct) // 100)::BIGINT AS need, coalesce(rows_c, 0)::BIGINT AS available,
  q.min_rows, (coalesce(rows_all, 0) * q.sample_permille) // 1000 * q.target_pct AS share, sum((coalesce(rows_all, 0) * q.sample_permille) // 1000 * q.target_pct) OVER (PARTITION BY q.plan_id) AS shares
FROM quota_targets q LEFT JOIN n ON n.record_set = q.record_set LEFT JOIN k ON k.record_set = q.record_set AND k.c = lower(trim(q.category))
)
"""
P2_SQL = _P2_SQL + "SELECT plan_id, category FROM t WHERE available < need"
# Largest remainder: the units left after rounding down go to the largest remainders, here to as many rows as are left.
P2_REPORT_SQL = _P2_SQL + r"""
, f AS (SELECT *, share // 100 AS low, share % 100 AS rest, (shares + 99) // 100 - sum(share // 100) OVER (PARTITION BY plan_id) AS units FROM t),
o AS (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY rest DESC, category) AS place FROM f),
e AS (SELECT *, least(available, greatest(min_rows, low + CASE WHEN place <= units AND rest > 0 THEN 1 ELSE 0 END))::BIGINT AS drawn FROM o)
SELECT plan_id, category, target_pct, need, available, drawn, drawn >= need AS met FROM e
"""
P2_SAMPLE_CHECKS_SQL = "SELECT plan_id, category, drawn AS rows, drawn AS ids, drawn AS fitting FROM (" + P2_REPORT_SQL + ")"
