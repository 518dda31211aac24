"""Table constraints as data checks.

A database rejects the load on a violation; here each rule is a query that returns the
violating rows (or a per-rule count), so a load can fail (reference-like) or quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, cols: Sequence[str], key: str, table: str = "") -> DataFrame:
    """(table_name, column_name, row_key) for every NULL in ``cols``: one pass, exploded hits."""
    hits = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]), lambda x: x.isNotNull())
    return (df.select(F.col(key).cast("long").alias("row_key"), hits.alias("_h")).where(F.size("_h") > 0)
            .select(F.lit(table).alias("table_name"), F.explode("_h").alias("column_name"), "row_key"))


def check_unique(df: DataFrame, cols: Sequence[str], nulls_distinct: bool = True) -> DataFrame:
    """Key values held by more than one row: (cols..., n_rows).

    With ``nulls_distinct`` (SQL default) a key with a NULL part never collides, so such
    rows are skipped before grouping. Grouping pre-aggregates on the map side, so a hot
    key costs one partial count per task, not a shuffle of its rows.
    """
    rows = df
    if nulls_distinct:
        for c in cols:
            rows = rows.where(F.col(c).isNotNull())
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def check_foreign_key(child: DataFrame, parent: DataFrame, cols: Sequence[str],
                      parent_cols: Sequence[str]) -> DataFrame:
    """Child rows whose (non-NULL) key has no parent row: a left anti join."""
    rows = child
    for c in cols:
        rows = rows.where(F.col(c).isNotNull())
    p = parent.select(*[F.col(pc).alias(f"_p{i}") for i, pc in enumerate(parent_cols)])
    cond = [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(cols)]
    return rows.join(p, cond, "left_anti")


def check_expression(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where ``condition`` is false (NULL passes, as in SQL CHECK)."""
    return df.where(~F.coalesce(condition, F.lit(True)))


def check_length(df: DataFrame, col: str, max_len: int) -> DataFrame:
    """Rows whose text is longer than ``max_len`` characters."""
    return df.where(F.length(col) > max_len)


def cascade_delete(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows left after deleting the parents in ``deleted`` (ON DELETE CASCADE)."""
    return child.join(deleted.select(key), key, "left_anti")


def _by_table(tables: dict[str, DataFrame], rules) -> dict[str, list]:
    out: dict[str, list] = {}
    for r in rules:
        if r.table in tables:
            out.setdefault(r.table, []).append(r)
    return out


def length_summary(tables: dict[str, DataFrame], rules) -> DataFrame:
    """One row per VARCHAR(n) rule: (table_name, column_name, max_length, violations); one pass per table."""
    parts = []
    for table, own in _by_table(tables, rules).items():
        one = tables[table].agg(*[F.count_if(F.length(r.column) > r.length).cast("long").alias(f"v{i}")
                                  for i, r in enumerate(own)])
        rows = [F.struct(F.lit(table).alias("table_name"), F.lit(r.column).alias("column_name"),
                         F.lit(r.length).cast("long").alias("max_length"), F.col(f"v{i}").alias("violations"))
                for i, r in enumerate(own)]
        parts.append(one.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    return _union(parts)


def broken(rule) -> Column:
    """Rows that break a NOT NULL, length or allowed-values rule."""
    c = F.col(rule.column)
    if hasattr(rule, "length"):
        return F.coalesce(F.length(c) > rule.length, F.lit(False))
    if hasattr(rule, "values"):
        return c.isNotNull() & ~c.isin(list(rule.values))
    return c.isNull()


def row_violations(df: DataFrame, rules: dict[str, object]) -> dict[str, int]:
    """Violations of each named row rule, counted in one pass over the table (and its rows as ``rows``)."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(broken(r)).alias(f"v{i}")
                                                    for i, r in enumerate(rules.values())]).first()
    return {"rows": int(row["rows"])} | {name: int(row[f"v{i}"]) for i, name in enumerate(rules)}


def foreign_key_summary(tables: dict[str, DataFrame], rules) -> DataFrame:
    """One row per foreign key: (table_name, column_name, parent_table, violations)."""
    parts = []
    for r in rules:
        if r.table not in tables or r.parent not in tables:
            continue
        bad = check_foreign_key(tables[r.table], tables[r.parent], r.columns, r.parent_columns)
        parts.append(bad.agg(F.count(F.lit(1)).cast("long").alias("violations")).select(
            F.lit(r.table).alias("table_name"), F.lit(",".join(r.columns)).alias("column_name"),
            F.lit(r.parent).alias("parent_table"), "violations"))
    return _union(parts)


def check_summary(tables: dict[str, DataFrame], rules) -> DataFrame:
    """One row per allowed-values CHECK: (table_name, column_name, violations)."""
    parts = []
    for r in rules:
        if r.table not in tables:
            continue
        cond = F.col(r.column).isin(list(r.values)) | F.col(r.column).isNull()
        parts.append(check_expression(tables[r.table], cond).agg(F.count(F.lit(1)).cast("long").alias("violations"))
                     .select(F.lit(r.table).alias("table_name"), F.lit(r.column).alias("column_name"), "violations"))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
