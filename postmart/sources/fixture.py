"""Postings-shaped input derived from the TPC-H-like test tables.

The test data holds no job postings, so a raw postings frame is derived from
``orders``, ``customer``, ``nation``, ``region``, ``lineitem`` and ``part``. Dirty values
(blank names, prefixes, odd flag spellings, NULLs) are placed by residues of the order
key, so the frame is deterministic and scales with the tables. ``id`` is the order key.

* ``postings_raw``: what the CSV reader hands over after its two converters - text
  cells, plus ``job_skills`` as array<string> and ``job_type_skills`` as
  map<string, array<string>>.
* ``postings_text``: every cell as CSV text, lists and dicts as Python literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(k: Column, n: int, mapping: dict[int, Column | None], default: Column | None = None) -> Column:
    """CASE k % n WHEN r THEN v ... ELSE default END."""
    expr = None
    for r, v in mapping.items():
        val = F.lit(None).cast("string") if v is None else v
        expr = F.when(k % n == r, val) if expr is None else expr.when(k % n == r, val)
    return expr.otherwise(F.lit(None).cast("string") if default is None else default)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, p_type, p_name, small): the parts of each order; the types of small ones (p_size < 25) make its dict."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").where("l_orderkey IS NOT NULL")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", (F.col("p_size") < 25).alias("small"))
    items = li.join(part, li.l_partkey == part.p_partkey, "inner").select(F.col("l_orderkey").alias("id"), "p_type", "p_name", "small")
    # A skill that no dict mentions, for every eleventh order.
    extra = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 11 == 0).select(
        F.col("o_orderkey").alias("id"), F.lit(None).cast("string").alias("p_type"), F.col("o_orderpriority").alias("p_name"),
        F.lit(False).alias("small"))
    return items.unionByName(extra)


def skill_cells(items: str = "_items") -> tuple[Column, Column]:
    """Skill list and {part type: part names} dict of the collected items of an order; NULL without any."""
    small = F.filter(items, lambda x: x["small"])
    types = F.array_sort(F.array_distinct(F.transform(small, lambda x: x["p_type"])))
    names_for = lambda t: F.array_sort(F.array_distinct(
        F.transform(F.filter(small, lambda x: x["p_type"] == t), lambda x: x["p_name"])))
    skills = F.array_sort(F.array_distinct(F.transform(items, lambda x: F.concat(F.upper(x["p_name"]), F.lit(" ")))))
    return (F.when(F.size(items) > 0, skills).alias("job_skills"),
            F.when(F.size(types) > 0, F.map_from_arrays(types, F.transform(types, names_for))).alias("job_type_skills"))


def postings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings as the CSV reader would hand them over (see module doc), in ranges of ascending ``id``.

    Orders and their items are dealt by ranges of the order key in one shuffle, as narrow rows; the
    window that collects an order's items and the order of the result both rest on its one sort, and
    the wide cells are made where the rows then lie. An order has a handful of line items.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    base = (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .join(n, c.c_nationkey == n.n_nationkey, "inner")
            .join(r, n.n_regionkey == r.r_regionkey, "inner"))
    order = F.struct("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "c_custkey", "c_name", "c_mktsegment",
                     "n_name", "r_name")
    item = F.struct("p_type", "p_name", "small")
    rows = base.select(F.col("o_orderkey").alias("id"), order.alias("_order")).unionByName(
        order_items(spark, sf_dir).select("id", item.alias("_item")), allowMissingColumns=True)
    base = (rows.repartitionByRange("id").sortWithinPartitions("id")
            .withColumn("_items", F.collect_list("_item").over(Window.partitionBy("id")))
            .where("_order IS NOT NULL").select("id", "_items", "_order.*"))
    k = F.col("id")
    seg, cname, nname, rname = F.col("c_mktsegment"), F.col("c_name"), F.col("n_name"), F.col("r_name")
    prio, status, price = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
    null_s = F.lit(None).cast("string")
    return base.select(
        k,
        F.when(k % 97 == 0, null_s).when(k % 5 == 0, seg).otherwise(F.lower(seg)).alias("job_title_short"),
        F.when((k % 31 == 0) | (k % 97 == 0), null_s).otherwise(F.concat(seg, F.lit(" "), cname)).alias("job_title"),
        _case(k, 7, {0: None, 1: nname, 2: F.concat(nname, F.lit(", "), rname)},
              F.concat(F.lit("City "), (F.col("c_custkey") % 50).cast("string"), F.lit(" , "), nname,
                       F.lit(","), rname)).alias("job_location"),
        _case(k, 4, {0: F.concat(F.lit("via "), prio), 1: F.concat(F.lit("Melalui  "), prio),
                     2: F.concat(prio, F.lit(" "))}).alias("job_via"),
        F.when(k % 9 == 0, F.lit("  ")).when(k % 10 == 0, null_s).otherwise(F.concat(F.lit(" "), status))
        .alias("job_schedule_type"),
        _case(k, 5, {0: F.lit("True"), 1: F.lit("FALSE"), 2: F.lit("1"), 3: F.lit("false")})
        .alias("job_work_from_home"),
        rname.alias("search_location"),
        F.when(k % 53 == 0, null_s).otherwise(F.col("o_orderdate").cast("string")).alias("job_posted_date"),
        _case(k, 3, {0: F.lit("true"), 1: F.lit("false")}).alias("job_no_degree_mention"),
        F.when(k % 2 == 0, F.lit("TRUE")).otherwise(F.lit("False")).alias("job_health_insurance"),
        F.when(k % 13 == 0, null_s).when(k % 17 == 0, F.lit("Unknown")).otherwise(rname).alias("job_country"),
        _case(k, 6, {0: F.lit("hour"), 1: None, 2: F.lit("month")}, F.lit("year")).alias("salary_rate"),
        F.when(k % 6 == 1, F.lit(None).cast("double")).otherwise(price).alias("salary_year_avg"),
        F.when(k % 6 == 0, price / 2080).otherwise(F.lit(None).cast("double")).alias("salary_hour_avg"),
        F.when(k % 101 == 0, null_s).when(k % 103 == 0, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), cname, F.lit(" "))).alias("company_name"),
        *skill_cells(),
    )


def _py_list_literal(arr: Column) -> Column:
    """array<string> -> Python list literal text, e.g. ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                    F.lit("]"))


def _py_dict_literal(m: Column) -> Column:
    """map<string, array<string>> -> Python dict literal text."""
    entries = F.transform(F.map_entries(m), lambda e: F.concat(
        F.lit("'"), e["key"], F.lit("': "), _py_list_literal(e["value"])))
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def postings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell as the CSV holds it: lists and dicts as Python literals, numbers as text."""
    return to_text(postings_raw(spark, sf_dir))


def to_text(raw: DataFrame) -> DataFrame:
    """Raw postings -> CSV cell text (a projection, no data movement)."""
    return raw.withColumns({
        "salary_year_avg": F.col("salary_year_avg").cast("string"),
        "salary_hour_avg": F.col("salary_hour_avg").cast("string"),
        "job_skills": F.when(F.col("job_skills").isNotNull(), _py_list_literal(F.col("job_skills"))),
        "job_type_skills": F.when(F.col("job_type_skills").isNotNull(), _py_dict_literal(F.col("job_type_skills"))),
    })
