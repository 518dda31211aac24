"""CSV scan, raw-to-staging coercion and row ids.

The CSV is read with an all-text schema (no inference pass over the data), missing
tokens are nulled column by column, and ``stage`` turns the raw frame into the staging
schema with JVM-side expressions only (cells that only Python's parser reads aside).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import (encode_json, infer_format, mend_cells, normalize_list, null_tokens, read_json, read_list, to_decimal,
                               to_timestamp, tri_state_bool, unread_dict, unread_list)
from ..operators.keys import dense_key
from ..schemas import EMPTY_DICT_TOKENS, EMPTY_LIST_TOKENS, FLAG_COLUMNS, PANDAS_NA_TOKENS, RAW_COLUMNS, SEMI_STRUCTURED, STAGING_SCHEMA
from ..session import fresh_dir


def csv_reader(reader, columns: list[str], multiline: bool):
    """The one way posting CSV files are read, by a batch or a stream: text cells, strict headers.

    Every file's header must hold ``columns`` in this order; a file with another header stops
    the read instead of being mapped by position. Without ``multiline`` files split into many
    tasks, and a record that does not have all cells (as the parts of a cell with a line
    break) stops the read too.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (reader.schema(schema).option("header", True).option("enforceSchema", False).option("multiLine", multiline)
            .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("columnPruning", False).option("mode", "PERMISSIVE" if multiline else "FAILFAST"))


def scan_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
             tokens: list[str] | None = None, multiline: bool = False, with_source: bool = True,
             extra: str = "drop") -> DataFrame:
    """Read posting CSV files as text (S1) and null the missing tokens.

    Columns are matched by header name. All files of ``path`` must have the same header (see
    ``csv_reader``). No type inference pass: every cell is text. Columns not in ``columns`` are
    dropped (``extra="drop"``) or rejected (``extra="error"``); missing ones stay absent so the
    schema check reports them. ``multiline=True`` allows quoted line breaks but reads each file
    in one task. Converter columns (the list / dict cells) keep their raw text: their parser
    decides. With ``with_source`` the file path and block start are kept for ``create_row_id``.
    """
    cols = columns or RAW_COLUMNS
    header = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path).columns
    extras = [c for c in header if c not in cols]
    if extras and extra == "error":
        raise ValueError(f"unexpected columns in {path}: {extras}")
    keep = [c for c in cols if c in header]
    df = csv_reader(spark.read, header, multiline).csv(path).select(*[F.col(f"`{c}`") for c in keep])
    if with_source:
        df = df.withColumns({"_src_file": F.col("_metadata.file_path"),
                             "_src_block": F.col("_metadata.file_block_start"),
                             "_src_pos": F.monotonically_increasing_id()})
    plain = [c for c in keep if c not in SEMI_STRUCTURED]
    return null_tokens(df, plain, PANDAS_NA_TOKENS if tokens is None else tokens)


#: Splits up to which their offsets (about 32 bytes each) are broadcast; beyond, the join is a shuffle.
MOST_BROADCAST_SPLITS = 200_000


def arrival_ids(df: DataFrame, out: str = "id", start: int = 1) -> DataFrame:
    """Ids rising in arrival order - file, split, line - without shuffling the rows.

    The rows of one input split are read in order by one task, so their
    ``monotonically_increasing_id`` values are consecutive. One small aggregation gives
    each split its row count and first position, written to the shared folder; running
    offsets over the splits turn each row's position inside its split into a global rank.
    The offsets have one row per split (about 32 bytes: the file path travels as a 64-bit
    hash) and are broadcast only when counted to be few; two paths sharing a hash stop
    the job instead of being numbered wrongly.
    """
    rows = df.withColumn("_src_fh", F.xxhash64("_src_file"))
    split = ["_src_fh", "_src_block"]
    per_split = rows.groupBy("_src_file", "_src_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_src_pos").alias("_first"))
    path = fresh_dir(df.sparkSession, "splits")
    per_split.write.parquet(path)
    per_split = df.sparkSession.read.parquet(path)
    few = per_split.count() <= MOST_BROADCAST_SPLITS
    before = Window.orderBy(F.col("_src_file").asc(), F.col("_src_block").asc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    ranked = per_split.select(F.xxhash64("_src_file").alias("_src_fh"), "_src_block", "_first",
                              F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    unique = ranked.groupBy(*split).agg(F.count(F.lit(1)).alias("_k"), F.first("_first").alias("_first"),
                                        F.first("_off").alias("_off"))
    # assert_true yields NULL when the check holds; filtering on it keeps it in the plan.
    offsets = unique.where(F.assert_true(F.col("_k") == 1, "file path hash collision").isNull()) \
        .select(*split, "_first", "_off")
    keyed = rows.join(F.broadcast(offsets) if few else offsets, split, "inner")
    rank = F.col("_off") + (F.col("_src_pos") - F.col("_first")) + F.lit(start)
    return keyed.withColumn(out, rank.cast("long")).drop(
        "_off", "_first", "_src_fh", "_src_file", "_src_block", "_src_pos")


def create_row_id(df: DataFrame, order_cols: list[str] | None = None, out: str = "id") -> DataFrame:
    """Unique ids rising in arrival order (P8); ``order_cols`` numbers by other columns instead."""
    if order_cols is None:
        return arrival_ids(df, out)
    keyed = dense_key(df, order_cols, out)
    return keyed.drop(*[c for c in ("_src_file", "_src_block", "_src_pos") if c in keyed.columns])


#: Raw text of the cells that only Python's own parser might read, beside the parsed columns.
UNREAD = {"job_skills": "_unread_list", "job_type_skills": "_unread_dict"}
#: Marks of the cells that held text other than an empty literal, for the structure check.
PRESENT = {"job_skills": "_has_list", "job_type_skills": "_has_dict"}


def parse_cells(df: DataFrame) -> DataFrame:
    """Converter step for text input: list literal cells -> array, dict literal cells -> JSON text.

    All on the JVM; ``UNREAD`` columns keep the text of cells that need ``mend_unread``, ``PRESENT``
    columns tell an invalid cell from a missing one.
    """
    text = [c for c in UNREAD if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    read = {"job_skills": read_list, "job_type_skills": read_json}
    empty = {"job_skills": EMPTY_LIST_TOKENS, "job_type_skills": EMPTY_DICT_TOKENS}
    marks = {"job_skills": unread_list, "job_type_skills": lambda c: unread_dict(c, read_json(c))}
    has = [F.coalesce(~F.col(c).isin(list(empty[c])), F.lit(False)).alias(PRESENT[c]) for c in text]
    return df.select("*", *has, *(F.when(marks[c](c), F.col(c)).alias(UNREAD[c]) for c in text)).withColumns(
        {c: read[c](c) for c in text})


def mend_unread(parsed: DataFrame) -> DataFrame:
    """The written result of ``parse_cells``, its unread cells read by Python where there are any."""
    held = {c: m for c, m in UNREAD.items() if m in parsed.columns}
    if not held:
        return parsed
    return mend_cells(parsed, {c: m for c, m in held.items() if c == "job_skills"},
                      {c: m for c, m in held.items() if c == "job_type_skills"})


#: As a date format: the one that the column itself shows.
INFER = "infer"


def date_format_of(raw: DataFrame, date_format: str | list[str] | None, column: str = "job_posted_date") -> str | list[str] | None:
    """``date_format``, or with INFER the format of the column; None (ISO, cell by cell) where it shows no other."""
    if date_format != INFER:
        return date_format
    found = infer_format(raw, column) if column in raw.columns else None
    return None if found is None or found.startswith("yyyy-") else found


def stage(raw: DataFrame, date_format: str | list[str] | None = None) -> DataFrame:
    """Raw (converted) postings -> staging schema.

    Flags: 'true'/'false' in any case, else NULL. Date: ISO text (or ``date_format``; for INFER see ``date_format_of``) ->
    timestamp, bad -> NULL, counted by ``lost_cells``. Salaries -> decimal(10,2). Skill list kept as array; skill dict stored as
    JSON text. Columns missing from the input become NULL.
    """
    exprs = {}
    for field in STAGING_SCHEMA.fields:
        name = field.name
        if name not in raw.columns:
            exprs[name] = F.lit(None).cast(field.dataType)
        elif name in FLAG_COLUMNS:
            exprs[name] = tri_state_bool(name)
        elif name == "job_posted_date":
            exprs[name] = to_timestamp(name, date_format)
        elif name in ("salary_year_avg", "salary_hour_avg"):
            exprs[name] = to_decimal(name)
        elif name == "job_skills":
            exprs[name] = normalize_list(raw, name)
        elif name == "job_type_skills":
            dtype = raw.schema[name].dataType
            exprs[name] = encode_json(name) if isinstance(dtype, T.MapType) else F.col(name).cast("string")
        elif name == "id":
            exprs[name] = F.col(name).cast("long")
        else:
            exprs[name] = F.col(name).cast(field.dataType)
    return raw.select(*[exprs[f.name].alias(f.name) for f in STAGING_SCHEMA.fields])


def lost_cells(raw: DataFrame, date_format: str | list[str] | None = None) -> dict[str, int]:
    """Cells with a value that staging turns into NULL, by column, in one pass over converted postings."""
    staged = {"job_posted_date": to_timestamp("job_posted_date", date_format), "salary_year_avg": to_decimal("salary_year_avg"),
              "salary_hour_avg": to_decimal("salary_hour_avg")}
    present = {c: e for c, e in staged.items() if c in raw.columns}
    if not present:
        return {}
    row = raw.agg(*[F.count_if(F.col(c).isNotNull() & e.isNull()).alias(c) for c, e in present.items()]).first()
    return {c: int(row[c]) for c in present}


def write_csv(df: DataFrame, path: str, order_col: str = "id", in_order: bool = False) -> None:
    """Write text postings as header CSV files, in ``order_col`` order across files.

    ``in_order``: the rows stand in that order already, over partitions too, and are not moved.
    """
    ordered = df if in_order else df.repartitionByRange(order_col).sortWithinPartitions(order_col)
    (ordered.drop(order_col).write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
