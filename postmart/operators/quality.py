"""Validation and data-quality metrics (V1-V12) as distributed aggregations.

Every metric is computed by one aggregation pass and returned as a small frame (one
row per column or per rule), never by pulling data to the driver. The gate (V4) is the
only action: it asks whether any failing row exists.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import read_dict, read_list
from ..schemas import EMPTY_DICT_TOKENS, EMPTY_LIST_TOKENS, MONEY, RAW_COLUMNS, SALARY_RATES

# ---------------------------------------------------------------------------
# V1-V4: schema rules and the gate
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Typed:
    """Values must coerce to ``dtype`` (NULL passes)."""
    column: str
    dtype: T.DataType


@dataclass(frozen=True)
class Fits:
    """Numbers must fit decimal(precision, scale); what is no number is left to Typed (NULL passes)."""
    column: str
    precision: int
    scale: int


@dataclass(frozen=True)
class IsIn:
    """Values must be one of ``values`` (NULL passes)."""
    column: str
    values: tuple


@dataclass(frozen=True)
class Min:
    """Values must be >= ``bound`` (NULL passes)."""
    column: str
    bound: float


def posting_rules() -> list:
    """The raw-posting schema: two numeric columns with a lower bound, one value list."""
    return [
        Typed("salary_year_avg", T.DoubleType()),
        Typed("salary_hour_avg", T.DoubleType()),
        Fits("salary_year_avg", MONEY.precision, MONEY.scale),
        Fits("salary_hour_avg", MONEY.precision, MONEY.scale),
        IsIn("salary_rate", tuple(SALARY_RATES)),
        Min("salary_year_avg", 0.0),
        Min("salary_hour_avg", 0.0),
    ]


#: Text that is a number: Spark's cast also takes Java's type suffixes, as in 1.0d or 5f.
NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"


def _failing(rule) -> tuple[str, Column]:
    c = F.col(rule.column)
    if isinstance(rule, Typed):
        bad = c.try_cast(rule.dtype).isNull()
        if isinstance(rule.dtype, T.NumericType):
            bad = bad | ~c.cast("string").rlike(NUMBER)
        return "coerce_dtype", c.isNotNull() & bad
    if isinstance(rule, Fits):
        fits = c.try_cast(T.DecimalType(rule.precision, rule.scale))
        return "numeric_range", F.coalesce(c.cast("string").rlike(NUMBER), F.lit(False)) & fits.isNull()
    if isinstance(rule, IsIn):
        return "isin", c.isNotNull() & ~c.isin(list(rule.values))
    if isinstance(rule, Min):
        return "greater_than_or_equal_to", c.isNotNull() & (c.try_cast("double") < F.lit(rule.bound))
    raise TypeError(f"unknown rule {rule!r}")


def find_failures(df: DataFrame, rules: Sequence, row_id: str = "id",
                  required: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """All failing cells in one pass (lazy validation): (check, column, row_id, value).

    A missing required column yields one row with NULL row_id. Each rule becomes a
    tagged struct; the failing ones are exploded, so the data is scanned once.
    """
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    present_rules = [r for r in rules if r.column in df.columns]
    out_schema = "check string, column_name string, row_id long, value string"
    parts = []
    if present_rules:
        tagged = []
        for r in present_rules:
            name, bad = _failing(r)
            tagged.append(F.when(bad, F.struct(F.lit(name).alias("check"), F.lit(r.column).alias("column_name"),
                                               F.col(r.column).cast("string").alias("value"))))
        hits = df.select(F.col(row_id).cast("long").alias("row_id"),
                         F.filter(F.array(*tagged), lambda x: x.isNotNull()).alias("_hits"))
        parts.append(hits.where(F.size("_hits") > 0).select(F.explode("_hits").alias("h"), "row_id")
                     .select("h.check", "h.column_name", "row_id", "h.value"))
    if missing:
        parts.append(spark.createDataFrame([("column_in_dataframe", c, None, None) for c in missing], out_schema))
    if not parts:
        return spark.createDataFrame([], out_schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failure_summary(df: DataFrame, rules: Sequence, required: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """One row per rule with its number of failing rows (zeros included), one pass."""
    spark = df.sparkSession
    present_rules = [r for r in rules if r.column in df.columns]
    aggs = []
    for i, r in enumerate(present_rules):
        _, bad = _failing(r)
        aggs.append(F.count_if(bad).alias(f"r{i}"))
    counts = df.agg(*aggs) if aggs else None
    rows = []
    for i, r in enumerate(present_rules):
        name, _ = _failing(r)
        rows.append(F.struct(F.lit(name).alias("check"), F.lit(r.column).alias("column_name"),
                             F.col(f"r{i}").cast("long").alias("failures")))
    for c in required:
        rows.append(F.struct(F.lit("column_in_dataframe").alias("check"), F.lit(c).alias("column_name"),
                             F.lit(0 if c in df.columns else 1).cast("long").alias("failures")))
    base = counts if counts is not None else spark.range(1)
    return base.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def gate(failures: DataFrame) -> tuple[bool, str | None]:
    """Stop-the-load decision (V4): passes when no failing row exists.

    All failing cells are reduced to their distinct (check, column) pairs before anything
    reaches the driver, so every failing column is named and the result is bounded by the rules.
    """
    found = failures.select("check", "column_name").distinct().collect()
    if not found:
        return True, None
    return False, "postings break the rules for " + ", ".join(sorted(f"{r['column_name']} ({r['check']})" for r in found))


# ---------------------------------------------------------------------------
# metrics
# ---------------------------------------------------------------------------


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def duplicate_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that repeat an earlier row over ``cols`` (NULL equals NULL in grouping)."""
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def _half_up_pct(n: Column, total: Column, digits: int) -> Column:
    """100*n/total rounded half-up to ``digits`` places with exact decimal arithmetic; NULL when total is 0."""
    scale = 10 ** digits
    num = n.cast("decimal(38,0)") * F.lit(200 * scale).cast("decimal(38,0)") + total.cast("decimal(38,0)")
    den = total.cast("decimal(38,0)") * F.lit(2).cast("decimal(38,0)")
    return F.when(total > 0, F.floor(num / den).cast("double") / F.lit(float(scale)))


def missing_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, missing_count, missing_pct) for each column, in one pass."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").cast("long").alias("missing_count"),
                     _half_up_pct(F.col(f"m{i}"), F.col("_total"), 2).alias("missing_pct"))
            for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, v): every cell as its column's number and its text; -0.0 is 0.0 and all NaN are one value, in text too."""
    def value(c):
        floating = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
        return (F.col(c) + 0.0 if floating else F.col(c)).cast("string")
    return df.select(F.explode(F.array(*(F.struct(F.lit(i).alias("i"), value(c).alias("v")) for i, c in enumerate(cols)))).alias("c")).select("c.*")


def unique_values(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """(column_name, unique_count): distinct non-NULL values per column.

    Cells are narrow (column number, text) pairs, each value counted once per task before the
    shuffle; a wide aggregate of distinct counts would copy whole rows once per column.
    ``exact=False`` uses HyperLogLog sketches (one small partial per task) for very large tables.
    """
    if exact:
        counts = _cells(df, cols).where("v IS NOT NULL").distinct().groupBy("i").agg(F.count(F.lit(1)).alias("n"))
        names = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name")) for i, c in enumerate(cols)))
        declared = df.sparkSession.range(1).select(F.explode(names).alias("d")).select("d.*")
        return declared.join(counts, "i", "left").select("column_name", F.coalesce("n", F.lit(0)).cast("long").alias("unique_count"))
    one = df.agg(*[F.approx_count_distinct(F.col(c)).alias(f"u{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"u{i}").cast("long").alias("unique_count"))
            for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def data_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, data_type) from the schema (no data is read)."""
    wanted = cols or df.columns
    pairs = [(c, df.schema[c].dataType.simpleString()) for c in wanted]
    return df.sparkSession.createDataFrame(pairs, "column_name string, data_type string")


def data_profile(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Per column: type, NULL count, NULL % (1 decimal), distinct count; plus the shape.

    Values are unpivoted to (column number, text) and counted per distinct value, which
    combines before the shuffle; a wide aggregate of exact distinct counts would copy every
    row once per column and keep all of it. ``exact=False`` needs no shuffle of values.
    """
    n_columns = F.lit(len(df.columns)).cast("long").alias("n_columns")
    names = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name"),
                               F.lit(df.schema[c].dataType.simpleString()).alias("data_type"))
                      for i, c in enumerate(cols)))
    long = _cells(df, cols)
    if exact:
        values = long.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
        counts = values.groupBy("i").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("v").isNull(), F.col("n"))).alias("nulls"),
                                         F.count("v").alias("distinct"))
    else:
        counts = long.groupBy("i").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("v").isNull()).alias("nulls"),
                                       F.approx_count_distinct("v").alias("distinct"))
    declared = df.sparkSession.range(1).select(F.explode(names).alias("d")).select("d.*")
    total, nulls = F.coalesce("total", F.lit(0)), F.coalesce("nulls", F.lit(0))
    return declared.join(counts, "i", "left").select(
        "column_name", "data_type", nulls.cast("long").alias("null_count"),
        _half_up_pct(nulls, total, 1).alias("null_pct"),
        F.coalesce("distinct", F.lit(0)).cast("long").alias("unique_count"), total.cast("long").alias("n_rows"), n_columns)


#: log2 of the buckets of a distinct-count sketch: 64 KiB at most, a standard error of about 0.4 percent.
SKETCH_BITS = 16


def profile_batch(df: DataFrame, cols: Sequence[str], path: str, batch: str) -> None:
    """Keep the profile of one load batch as mergeable rows under ``path``; the same batch again replaces its own.

    A row for each column: rows, NULLs and a HyperLogLog sketch of the values. The batch is read
    once, and what is shuffled is a sketch per column and task.
    """
    names = F.element_at(F.array(*map(F.lit, cols)), F.col("i") + 1)
    rows = _cells(df, cols).groupBy("i").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("v").isNull()).alias("nulls"),
                                             F.hll_sketch_agg("v", SKETCH_BITS).alias("sketch"))
    (rows.select(names.alias("column_name"), "n_rows", "nulls", "sketch", F.lit(batch).alias("batch"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def merged_profile(spark: SparkSession, path: str) -> DataFrame:
    """The profile of all batches kept under ``path``, from their few rows alone; unique_count is estimated."""
    kept = spark.read.schema("column_name string, n_rows long, nulls long, sketch binary, batch string").parquet(path)
    merged = kept.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("nulls").alias("null_count"),
                                             F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_count"))
    return merged.select("column_name", "null_count", _half_up_pct(F.col("null_count"), F.col("n_rows"), 1).alias("null_pct"),
                         "unique_count", "n_rows")


# ---------------------------------------------------------------------------
# Structure of the semi-structured columns. They read cells on the JVM; ``parse_list`` /
# ``parse_dict`` as ``parse`` read every literal that Python's own parser does.
# ---------------------------------------------------------------------------


def _present(raw_col: str, tokens: Sequence[str]) -> Column:
    return F.col(raw_col).isNotNull() & ~F.col(raw_col).isin(list(tokens))


def list_structure(df: DataFrame, raw_col: str, parse=read_list) -> DataFrame:
    """List-column check over all rows: present, valid and invalid cells, and NULL items.

    A cell is present when its raw text is not missing nor an empty-list token; it is
    valid when it parses into a list. Every present cell is parsed once.
    """
    valid = F.col("_p").isNotNull()
    return df.where(_present(raw_col, EMPTY_LIST_TOKENS)).select(parse(raw_col).alias("_p")).agg(
        F.count(F.lit(1)).cast("long").alias("total_non_null"),
        F.count_if(valid).cast("long").alias("valid_lists"),
        F.count_if(~valid).cast("long").alias("invalid"),
        F.coalesce(F.sum(F.size(F.filter("_p", lambda x: x.isNull()))), F.lit(0)).cast("long").alias("null_items"))


def parsed_structure(parsed: DataFrame, present: str, value: str) -> DataFrame:
    """The structure check of a column that is parsed already: ``present`` marks the cells that held text."""
    valid = F.col(present) & F.col(value).isNotNull()
    return parsed.agg(F.count_if(present).cast("long").alias("total_non_null"), F.count_if(valid).cast("long").alias("valid"),
                      F.count_if(F.col(present) & F.col(value).isNull()).cast("long").alias("invalid"))


def list_samples(df: DataFrame, raw_col: str, n: int, id_col: str = "id", parse=read_list) -> DataFrame:
    """The first ``n`` valid lists by id, for a reader: (id, items). The limit is the feature."""
    return (df.where(_present(raw_col, EMPTY_LIST_TOKENS)).select(id_col, parse(raw_col).alias("items"))
            .where("items IS NOT NULL").orderBy(id_col).limit(n))


def dict_structure(df: DataFrame, raw_col: str, parse=read_dict) -> DataFrame:
    """Dict-column check over all rows: present, valid and invalid cells (see ``dict_categories`` for keys)."""
    valid = F.col("_p").isNotNull()
    return df.where(_present(raw_col, EMPTY_DICT_TOKENS)).select(parse(raw_col).alias("_p")).agg(
        F.count(F.lit(1)).cast("long").alias("total_non_null"),
        F.count_if(valid).cast("long").alias("valid_dicts"),
        F.count_if(~valid).cast("long").alias("invalid"))


def dict_categories(df: DataFrame, raw_col: str, parse=read_dict) -> DataFrame:
    """Every key of the valid dicts with the number of cells that hold it: (category, n_cells)."""
    return (df.where(_present(raw_col, EMPTY_DICT_TOKENS)).select(F.explode(F.map_keys(parse(raw_col))).alias("category"))
            .groupBy("category").agg(F.count(F.lit(1)).cast("long").alias("n_cells")))
