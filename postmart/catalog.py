"""Registered queries: one per operator of the inventory, over the test tables.

``Mart`` builds the postings mart lazily for one (session, data folder): staging is
derived from the test tables and written once as Parquet under the shared checkpoint
folder (it is the staging table of the load); dimensions, fact and bridge are built on
demand from it. Every query returns a flat frame (no arrays or maps; timestamps as
text, decimals as double) whose column names match its DuckDB oracle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import parse as P
from .functions import text as X
from .operators import bridge as B
from .operators import constraints as C
from .operators import dimensions as D
from .operators import facts as FX
from .operators import keys as K
from .operators import paging as O
from .operators import quality as Q
from .operators import scd as SCD
from .operators import star as H
from .schemas import (CHECK_RULES, FOREIGN_KEY_RULES, KEY_COLUMNS, LENGTH_RULES, PANDAS_NA_TOKENS,
                      RAW_COLUMNS, SEMI_STRUCTURED)
from .session import fresh_dir, scratch_under
from .sources import fixture as FIX
from .sources import ingest as I
from .sources import tables as TB

AS_OF = _dt.date(1999, 1, 1)          # fixed reference date of days_since_posted
EARLY_CUTOFF = "1995-01-01"           # first load of the incremental examples
SCD_FIRST, SCD_SECOND = "1995-01-01", "1999-01-01"   # the second snapshot holds all orders
PAGE_LIMIT, PAGE_OFFSET = 10000, 10000
PROFILE_COLUMNS = [c for c in RAW_COLUMNS if c not in SEMI_STRUCTURED]


class Mart:
    """Lazily built mart over one test-data folder; cached per Spark application."""

    _cache: dict[tuple[str, str], "Mart"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str, fresh: bool = False) -> "Mart":
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if fresh or key not in cls._cache:
            cls._cache[key] = cls(spark, sf_dir)
        return cls._cache[key]

    def table(self, name: str) -> DataFrame:
        return FIX.table(self.spark, self.sf_dir, name)

    # --- inputs -------------------------------------------------------------
    @cached_property
    def base(self) -> str:
        return fresh_dir(self.spark, "mart")

    @cached_property
    def raw(self) -> DataFrame:
        """Raw postings derived once from the test tables and kept as Parquet (the input file)."""
        path = f"{self.base}/raw"
        # An input file stands in arrival order, as the derived rows do.
        FIX.postings_raw(self.spark, self.sf_dir).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def text(self) -> DataFrame:
        return FIX.to_text(self.raw)

    @cached_property
    def staging(self) -> DataFrame:
        """Staging written once (the load's staging table), then scanned with pruning."""
        TB.append_staging(I.stage(self.raw), self.base)
        return TB.read_table(self.spark, self.base, "staging")

    @cached_property
    def csv_path(self) -> str:
        path = f"{self.base}/csv"
        I.write_csv(FIX.postings_text(self.spark, self.sf_dir).select("id", *RAW_COLUMNS), path, in_order=True)
        return path

    @cached_property
    def scanned(self) -> DataFrame:
        return I.scan_csv(self.spark, self.csv_path)

    # --- 3NF ----------------------------------------------------------------
    @cached_property
    def companies(self) -> DataFrame:
        return D.dim_companies(self.staging)

    @cached_property
    def locations(self) -> DataFrame:
        return D.dim_locations(self.staging)

    @cached_property
    def locations_ref(self) -> DataFrame:
        return D.dim_locations(self.staging, unique="nulls_distinct")

    @cached_property
    def platforms(self) -> DataFrame:
        return D.dim_platforms(self.staging)

    @cached_property
    def schedules(self) -> DataFrame:
        return D.dim_schedule_types(self.staging)

    @cached_property
    def categories(self) -> DataFrame:
        return D.dim_skill_categories(self.staging)

    @cached_property
    def skills(self) -> DataFrame:
        return D.dim_skills(self.staging, self.categories)

    @cached_property
    def jobs(self) -> DataFrame:
        return self._kept("jobs", FX.fact_jobs(self.staging, self.companies, self.locations, self.platforms, self.schedules,
                                               keep_staging_id=True))

    @cached_property
    def jobs_ref(self) -> DataFrame:
        return self._kept("jobs_ref", FX.fact_jobs(self.staging, self.companies, self.locations_ref, self.platforms,
                                                   self.schedules, keep_staging_id=True))

    def _kept(self, name: str, df: DataFrame) -> DataFrame:
        """Write a shared intermediate once (as a load writes its tables) and scan it back."""
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def bridge(self) -> DataFrame:
        return self._kept("job_skills", B.bridge_job_skills(self.jobs, self.staging, self.skills))

    @cached_property
    def bridge_id(self) -> DataFrame:
        return self._kept("job_skills_id", B.bridge_job_skills(self.jobs, self.staging, self.skills, match="id"))

    def tables(self) -> dict[str, DataFrame]:
        return {"staging": self.staging, "companies": self.companies, "locations": self.locations,
                "platforms": self.platforms, "schedule_types": self.schedules,
                "skill_categories": self.categories, "skills": self.skills, "jobs": self.jobs,
                "job_skills": self.bridge}

    # --- star ---------------------------------------------------------------
    @cached_property
    def star_location(self) -> tuple[DataFrame, DataFrame]:
        return H.star_dim_location(self.locations)

    @cached_property
    def star_titles(self) -> DataFrame:
        return H.star_dim_job_title(self.jobs)

    @cached_property
    def star_fact(self) -> DataFrame:
        return self._kept("fact_job_postings", H.star_fact_postings(self.jobs, self.bridge, self.star_location[1],
                                                                    self.star_titles, AS_OF))


# ---------------------------------------------------------------------------
# output helpers
# ---------------------------------------------------------------------------

def _ts(c: str) -> F.Column:
    return F.col(c).cast("string").alias(c)


def _dbl(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


def _joined(c: str, sep: str = "|") -> F.Column:
    return F.when(F.col(c).isNotNull(), F.array_join(c, sep)).alias(c)


def _size(c: str, out: str) -> F.Column:
    return F.when(F.col(c).isNotNull(), F.size(c)).cast("long").alias(out)


def _fact_out() -> list:
    shown = {"job_posted_date": _ts, "salary_year_avg": _dbl, "salary_hour_avg": _dbl}
    return [shown[c](c) if c in shown else F.col(c) for c in FX.FACT_COLUMNS]


def _m(spark, sf) -> Mart:
    return Mart.get(spark, sf)


# ---------------------------------------------------------------------------
# sources and parsing (S*, P*)
# ---------------------------------------------------------------------------

def q_scan_csv(spark, sf):
    df = _m(spark, sf).scanned
    return df.select(*[c for c in RAW_COLUMNS if c not in ("salary_year_avg", "salary_hour_avg")],
                     F.col("salary_year_avg").cast("double").alias("salary_year_avg"),
                     F.col("salary_hour_avg").cast("double").alias("salary_hour_avg"))


def _cells(col: str, *cases: tuple[int, str]) -> F.Column:
    """``col`` with the given text in the rows whose id is divisible by a number (the first that fits)."""
    out = None
    for n, text in cases:
        out = (F.when if out is None else out.when)(F.col("id") % n == 0, F.lit(text))
    return out.otherwise(F.col(col)).alias(col)


def q_null_tokens(spark, sf):
    cols = ["job_schedule_type", "job_work_from_home", "company_name", "job_via"]
    text = _m(spark, sf).text.select("id", *cols[:3], _cells("job_via", (61, "NA"), (67, "n/a"), (71, "-1.#IND")))
    return P.null_tokens(text, cols, PANDAS_NA_TOKENS + ["  ", "   ", "1"])


def q_staging_scan(spark, sf):
    s = _m(spark, sf).staging
    return s.select("id", "job_title_short", "job_title", "job_location", "job_via", "job_schedule_type",
                    "job_work_from_home", "search_location", _ts("job_posted_date"), "job_no_degree_mention",
                    "job_health_insurance", "job_country", "salary_rate", _dbl("salary_year_avg"),
                    _dbl("salary_hour_avg"), "company_name", _joined("job_skills"))


def q_parse_list(spark, sf):
    t = _m(spark, sf).text
    return t.select("id", P.read_list("job_skills").alias("v")).select(
        "id", _size("v", "n_items"), F.when(F.col("v").isNotNull(), F.array_join("v", "|")).alias("items"))


def q_parse_dict(spark, sf):
    t = _m(spark, sf).text
    return t.select("id", F.explode(P.read_dict("job_type_skills")).alias("category", "v")).select(
        "id", "category", F.array_join("v", "|").alias("items"))


def q_normalize_list(spark, sf):
    r = _m(spark, sf).raw
    as_json = r.select("id", F.to_json("job_skills").alias("job_skills")).select("id", F.when(
        F.col("id") % 83 == 0, F.concat("job_skills", F.lit(" junk"))).when(
        F.col("id") % 79 == 0, F.concat("job_skills", F.lit(',["x"]'))).otherwise(F.col("job_skills")).alias("job_skills"))
    return as_json.select("id", P.normalize_list(as_json, "job_skills").alias("v")).select(
        "id", _size("v", "n_items"), F.when(F.col("v").isNotNull(), F.array_join("v", "|")).alias("items"))


def q_encode_json(spark, sf):
    cells = _m(spark, sf).text.select("id", _cells("job_type_skills", *BAD_DICTS))
    return cells.select("id", P.read_json("job_type_skills").alias("json")).where("json IS NOT NULL")


def q_tri_state_bool(spark, sf):
    r = _m(spark, sf).raw
    return r.select("id", *[P.tri_state_bool(c).alias(c) for c in
                            ("job_work_from_home", "job_no_degree_mention", "job_health_insurance")])


def q_to_timestamp(spark, sf):
    r = _m(spark, sf).raw
    return r.select("id", P.to_timestamp("job_posted_date").cast("string").alias("job_posted_date"))


def q_infer_timestamp(spark, sf):
    """Dates written as day.month.year or month/day/year, each column in its one format, which is inferred."""
    o = _m(spark, sf).table("orders")
    day, month = "d.M.yyyy", "M/d/yyyy HH:mm"
    text = o.select("o_orderkey", F.when(F.col("o_orderkey") % 50 == 0, "n/a").otherwise(F.date_format("o_orderdate", day)).alias("a"),
                    F.when(F.col("o_orderkey") % 70 == 0, "soon").otherwise(F.date_format("o_orderdate", month)).alias("b"))
    return text.select("o_orderkey", *(P.to_timestamp(c, P.infer_format(text, c)).cast("string").alias(c) for c in ("a", "b")))


def q_to_decimal(spark, sf):
    r = _m(spark, sf).text
    return r.select("id", P.to_decimal("salary_year_avg").cast("double").alias("salary_year_avg"),
                    P.to_decimal("salary_hour_avg").cast("double").alias("salary_hour_avg"))


def q_create_row_id(spark, sf):
    s = I.create_row_id(_m(spark, sf).scanned)
    return s.select("id", "job_title", "company_name")


# ---------------------------------------------------------------------------
# validation and quality (V*)
# ---------------------------------------------------------------------------

def q_validate_schema(spark, sf):
    """Over text cells with faults of each kind, one column missing."""
    text = _m(spark, sf).text.drop("search_location").withColumns({
        "salary_year_avg": _cells("salary_year_avg", (41, "abc"), (43, "-5"), (47, "1.0d"), (59, "123456789012")),
        "salary_hour_avg": _cells("salary_hour_avg", (41, "5f"), (43, "-0.5"), (59, "1e9")),
        "salary_rate": _cells("salary_rate", (37, "century"))})
    return Q.failure_summary(text, Q.posting_rules())


def q_check_isin(spark, sf):
    o = _m(spark, sf).table("orders")
    rule = Q.IsIn("o_orderstatus", ("F", "O"))
    return Q.find_failures(o, [rule], row_id="o_orderkey", required=[])


def q_check_min(spark, sf):
    c = _m(spark, sf).table("customer")
    return Q.find_failures(c, [Q.Min("c_acctbal", 0.0)], row_id="c_custkey", required=[])


def q_row_count(spark, sf):
    return Q.row_count(_m(spark, sf).staging)


def q_duplicate_rows(spark, sf):
    return Q.duplicate_rows(_m(spark, sf).raw, KEY_COLUMNS)


def q_missing_values(spark, sf):
    return Q.missing_values(_m(spark, sf).raw, PROFILE_COLUMNS)


def q_unique_values(spark, sf):
    return Q.unique_values(_m(spark, sf).raw, KEY_COLUMNS)


BAD_LISTS = [(89, "not a list"), (83, "('a', 'b')"), (79, "['x', None]")]
BAD_DICTS = [(89, "not a dict"), (71, "{'open': ['x'"), (67, "{'n': 3, 'mixed': 'text', 'l': [1, True, None]}")]


def _bad_lists(spark, sf):
    return _m(spark, sf).text.select("id", _cells("job_skills", *BAD_LISTS))


def _bad_dicts(spark, sf):
    return _m(spark, sf).text.select("id", _cells("job_type_skills", *BAD_DICTS))


def q_list_structure(spark, sf):
    return Q.list_structure(_bad_lists(spark, sf), "job_skills")


def q_list_samples(spark, sf):
    return Q.list_samples(_bad_lists(spark, sf), "job_skills", 10).select("id", F.array_join("items", "|", "None").alias("items"))


def q_dict_structure(spark, sf):
    return Q.dict_structure(_bad_dicts(spark, sf), "job_type_skills")


def q_dict_categories(spark, sf):
    return Q.dict_categories(_bad_dicts(spark, sf), "job_type_skills")


def q_data_profile(spark, sf):
    return Q.data_profile(_m(spark, sf).raw, PROFILE_COLUMNS)


def q_batch_profile(spark, sf):
    """The profile of all orders from the kept profiles of their load batches, one for each order status."""
    m = _m(spark, sf)
    orders, path = m.table("orders"), fresh_dir(spark, "profiles")
    for status in ("F", "O", "P"):
        Q.profile_batch(orders.where(F.col("o_orderstatus") == status), ["o_orderstatus", "o_orderpriority", "o_orderdate"], path, status)
    return Q.merged_profile(spark, path)


# ---------------------------------------------------------------------------
# dimensions and keys (D*)
# ---------------------------------------------------------------------------

def q_dim_companies(spark, sf):
    return _m(spark, sf).companies


def q_parse_location(spark, sf):
    s = _m(spark, sf).staging
    city, state = X.parse_location("job_location")
    return s.select("job_location").distinct().select("job_location", city.alias("main_city"),
                                                      state.alias("main_state_province"))


def q_dim_locations(spark, sf):
    return _m(spark, sf).locations


def q_dim_locations_ref(spark, sf):
    return _m(spark, sf).locations_ref


def q_dim_platforms(spark, sf):
    return _m(spark, sf).platforms


def q_dim_schedule_types(spark, sf):
    return _m(spark, sf).schedules


def q_dim_skill_categories(spark, sf):
    return _m(spark, sf).categories


def q_dim_skills_categorized(spark, sf):
    pairs = D.skills_categorized(_m(spark, sf).staging)
    return pairs.groupBy("skill_name").agg(F.min("category_name").alias("category_name"))


def q_dim_skills_uncategorized(spark, sf):
    m = _m(spark, sf)
    listed = D.skills_uncategorized(m.staging).select("skill_name").distinct()
    return listed.join(D.skills_categorized(m.staging).select("skill_name"), "skill_name", "left_anti")


def q_dim_skills(spark, sf):
    return _m(spark, sf).skills


def q_map_category_id(spark, sf):
    m = _m(spark, sf)
    both = D.skills_categorized(m.staging).unionByName(D.skills_uncategorized(m.staging))
    members = both.groupBy("skill_name").agg(F.min("category_name").alias("category_name"))
    return D.map_category_id(members, m.categories).select("skill_name", "category_name", "category_id")


def q_surrogate_key(spark, sf):
    o = _m(spark, sf).table("orders").select("o_orderkey", "o_orderdate")
    keyed = K.dense_key(o, ["o_orderdate", "o_orderkey"], "order_seq")
    return keyed.select("o_orderkey", "order_seq")


def q_insert_if_absent(spark, sf):
    s = _m(spark, sf).staging
    early = D.dim_companies(s.where(F.col("job_posted_date") < F.lit(EARLY_CUTOFF).cast("timestamp_ntz")))
    incoming = s.where(X.not_blank("company_name")).select(X.clean_company("company_name").alias("company_name"))
    return K.insert_if_absent(early, incoming, ["company_name"], "company_id")


# ---------------------------------------------------------------------------
# projections, lookups, fact (F*, J1-J5)
# ---------------------------------------------------------------------------

def q_coalesce_title(spark, sf):
    s = _m(spark, sf).staging
    return s.select("id", X.coalesce_title("job_title", "job_title_short").alias("job_title"))


def q_filter_titled(spark, sf):
    return FX.titled(_m(spark, sf).staging).select("id")


def q_blank_filter(spark, sf):
    s = _m(spark, sf).staging
    return s.where(X.not_blank("company_name")).select("id", "company_name")


def q_default_unknown(spark, sf):
    s = _m(spark, sf).staging
    return s.select("id", X.default_unknown("job_country").alias("country"),
                    X.default_unknown("job_location").alias("full_location"))


def q_fact_projection(spark, sf):
    s = FX.titled(_m(spark, sf).staging)
    own = s.withColumn("job_title", X.coalesce_title("job_title", "job_title_short"))
    return own.select("id", *[c for c, name in zip(_fact_out(), FX.FACT_COLUMNS) if not name.endswith("_id")])


def q_text_normalize(spark, sf):
    e = B.explode_skills(_m(spark, sf).staging)
    return e.select("id", X.text_normalize("s_name").alias("skill_key")).distinct()


def _lookup_one(spark, sf, dim_attr, on, keep):
    m = _m(spark, sf)
    s = FX.with_lookup_keys(FX.titled(m.staging))
    return FX.lookup(s, getattr(m, dim_attr), on, keep, salt_by="id").select("id", *keep)


def q_lookup_company(spark, sf):
    return _lookup_one(spark, sf, "companies", {"_company_key": "company_name"}, ["company_id"])


def q_lookup_location(spark, sf):
    return _lookup_one(spark, sf, "locations", {"_country_key": "country", "_location_key": "full_location"},
                       ["location_id"])


def q_lookup_platform(spark, sf):
    return _lookup_one(spark, sf, "platforms", {"_platform_key": "platform_name"}, ["platform_id"])


def q_lookup_schedule(spark, sf):
    return _lookup_one(spark, sf, "schedules", {"_schedule_key": "schedule_type_name"}, ["schedule_type_id"])


def q_fact_jobs(spark, sf):
    return _m(spark, sf).jobs.select(*_fact_out())


def q_fact_jobs_ref(spark, sf):
    return _m(spark, sf).jobs_ref.select(*_fact_out())


# ---------------------------------------------------------------------------
# bridge (J6-J9), aggregates (A*), order / paging (O*)
# ---------------------------------------------------------------------------

def q_rejoin_staging(spark, sf):
    m = _m(spark, sf)
    return B.rejoin_groups(m.jobs, m.staging).select("job_title", _ts("job_posted_date"), "n_jobs", "n_staging", "n_pairs")


def q_explode_skills(spark, sf):
    return B.explode_skills(_m(spark, sf).staging).select("id", "s_name")


def q_match_skill(spark, sf):
    m = _m(spark, sf)
    return B.match_skill(B.explode_skills(m.staging), m.skills).select("id", "s_name", "skill_id")


def q_bridge_job_skills(spark, sf):
    return _m(spark, sf).bridge


def q_bridge_job_skills_id(spark, sf):
    return _m(spark, sf).bridge_id


def q_count_eligible(spark, sf):
    return FX.count_eligible(_m(spark, sf).staging)


def q_count_bridge(spark, sf):
    m = _m(spark, sf)
    return B.count_bridge(m.jobs, m.staging, m.skills)


def q_distinct_values(spark, sf):
    return _m(spark, sf).staging.select("job_location", "job_country").distinct()


def q_distinct_json(spark, sf):
    """Dict cells whose keys stand in the other order in every second row are the same documents."""
    turned = F.map_from_entries(F.reverse(F.map_entries("job_type_skills")))
    raw = _m(spark, sf).raw.withColumn("job_type_skills", F.when(F.col("id") % 2 == 0, turned).otherwise(F.col("job_type_skills")))
    return FIX.to_text(raw).select(P.read_json("job_type_skills").alias("job_type_skills")).where(
        "job_type_skills IS NOT NULL").distinct()


def q_distinct_jsonb(spark, sf):
    """Documents that differ in spaces, key order and the form of a number (2, 2.0, 2.00) only are one."""
    k, line = F.col("l_linenumber"), F.col("l_returnflag")
    number = F.concat(k.cast("string"), F.when(F.col("l_orderkey") % 3 == 0, ".0").when(F.col("l_orderkey") % 3 == 1, ".00").otherwise(""))
    text = F.when(F.col("l_orderkey") % 2 == 0, F.concat(F.lit('{"n": '), number, F.lit(', "flag": ["'), line, F.lit('"]}'))).otherwise(
        F.concat(F.lit('{"flag":["'), line, F.lit('"],"n":'), number, F.lit("}")))
    return _m(spark, sf).table("lineitem").select(P.canonical_json(text).alias("document")).distinct()


def q_literal_cells(spark, sf):
    """Dict cells in the spellings that Python allows: both quotes, escapes, single values, spaces, trailing commas, repeated keys."""
    k, name = F.col("p_partkey"), F.col("p_name")
    spelt = {0: F.concat(F.lit("{'n': ['"), name, F.lit("', 'x',], }")), 1: F.concat(F.lit('{ "n" : [ "'), name, F.lit('" , "it\'s" ] }')),
             2: F.concat(F.lit("{'n': ['"), name, F.lit("\\u00e9\\t\\x41', None, True, 7, -1.5]}")),
             3: F.concat(F.lit("{'n': '"), name, F.lit("', 'm': 3}")), 4: F.concat(F.lit("{'n': ['old'], 'n': ['"), name, F.lit("']}")),
             5: F.concat(F.lit("{'n': ['"), name, F.lit("'")), 6: F.lit("['no dict']")}
    cell = None
    for r, text in spelt.items():
        cell = F.when(k % 7 == r, text) if cell is None else cell.when(k % 7 == r, text)
    cells = _m(spark, sf).table("part").select("p_partkey", cell.alias("cell"))
    return cells.select("p_partkey", F.explode_outer(P.read_dict("cell")).alias("key", "v")).select(
        "p_partkey", "key", F.when(F.col("v").isNotNull(), F.array_join("v", "|", "None")).alias("items"))


def q_set_union(spark, sf):
    pairs = D.category_skill_pairs(_m(spark, sf).staging)
    return pairs.where(F.col("item").isNotNull()).select(
        F.col("category").alias("category_name"), X.skill_name("item").alias("skill_name")).distinct()


def q_pair_dedupe(spark, sf):
    m = _m(spark, sf)
    matched = B.match_skill(B.explode_skills(m.staging), m.skills).select("id", "skill_id")
    return B.pair_dedupe(matched, ("id", "skill_id"))


def q_order_by_id(spark, sf):
    return O.order_by(O.positions(_m(spark, sf).staging.select("id", "job_title"), ["id"]), ["position"])


def q_order_by_pair(spark, sf):
    return O.order_by(O.positions(_m(spark, sf).bridge, ["job_id", "skill_id"]), ["position"])


def q_page(spark, sf):
    return O.page(_m(spark, sf).jobs.select("job_id", "job_title", "company_id"), ["job_id"], PAGE_LIMIT, PAGE_OFFSET)


def q_head_n(spark, sf):
    return O.head_n(_m(spark, sf).staging.select("id", "job_title", "company_name"), ["id"], 10)


# ---------------------------------------------------------------------------
# constraints (C*)
# ---------------------------------------------------------------------------

def q_check_not_null(spark, sf):
    return C.check_not_null(_m(spark, sf).jobs, ["job_title", "company_id", "location_id"], "job_id", "jobs")


def q_check_unique(spark, sf):
    return C.check_unique(_m(spark, sf).locations_ref, ["country", "full_location"])


#: The number by which rows are told apart in the constraint queries, each of which breaks its rule in every third row.
ROW_KEYS = {"staging": "id", "locations": "location_id", "platforms": "platform_id", "schedule_types": "schedule_type_id",
            "skill_categories": "category_id", "skills": "skill_id", "jobs": "job_id", "job_skills": "job_id",
            "companies": "company_id"}


def _third(table: str) -> F.Column:
    return F.col(ROW_KEYS[table]) % 3 == 0


def q_check_foreign_key(spark, sf):
    """Every third row of a child refers to a parent that does not exist."""
    tables = _m(spark, sf).tables()
    parts = []
    for r in FOREIGN_KEY_RULES:
        c = r.columns[0]
        child = tables[r.table].withColumn(c, F.when(_third(r.table), -F.abs(F.col(c))).otherwise(F.col(c)))
        parts.append(C.foreign_key_summary(tables | {r.table: child}, [r]))
    return C._union(parts)


def q_check_expression(spark, sf):
    """Every third posting has a rate that is not allowed."""
    tables = _m(spark, sf).tables()
    jobs = tables["jobs"].withColumn("salary_rate", F.when(_third("jobs"), F.lit("century")).otherwise(F.col("salary_rate")))
    return C.check_summary(tables | {"jobs": jobs}, CHECK_RULES)


def q_check_length(spark, sf):
    """Every third text is one character too long."""
    tables = _m(spark, sf).tables()
    for r in LENGTH_RULES:
        tables[r.table] = tables[r.table].withColumn(r.column, F.when(
            _third(r.table), F.repeat(F.lit("y"), F.lit(r.length + 1))).otherwise(F.col(r.column)))
    return C.length_summary(tables, LENGTH_RULES)


def q_cascade_delete(spark, sf):
    m = _m(spark, sf)
    deleted = m.jobs.where(F.col("company_id").isNull())
    return C.cascade_delete(m.bridge, deleted, "job_id")


# ---------------------------------------------------------------------------
# star schema (H*)
# ---------------------------------------------------------------------------

def q_star_dim_company(spark, sf):
    return H.star_dim_company(_m(spark, sf).companies)


def q_star_dim_location(spark, sf):
    return _m(spark, sf).star_location[0]


def q_star_dim_date(spark, sf):
    d = H.star_dim_date(_m(spark, sf).jobs)
    return d.select(F.col("full_date").cast("string").alias("full_date"), "year", "quarter", "month", "day",
                    "day_of_week")


def q_star_dim_job_title(spark, sf):
    return _m(spark, sf).star_titles


def q_star_dim_platform(spark, sf):
    return H.star_dim_platform(_m(spark, sf).platforms)


def q_star_dim_schedule_type(spark, sf):
    return H.star_dim_schedule_type(_m(spark, sf).schedules)


def q_star_dim_skill(spark, sf):
    m = _m(spark, sf)
    return H.star_dim_skill(m.skills, m.categories)


def q_star_dim_attributes(spark, sf):
    m = _m(spark, sf)
    counts = m.star_fact.groupBy("attributes_key").agg(F.count(F.lit(1)).cast("long").alias("n_postings"))
    return H.star_dim_attributes(spark).join(counts, "attributes_key", "left").select(
        "attributes_key", "is_remote", "has_degree_req", "has_health_insurance", "attribute_combination_name",
        F.coalesce("n_postings", F.lit(0)).cast("long").alias("n_postings"))


def q_star_fact_postings(spark, sf):
    f = _m(spark, sf).star_fact
    return f.select(*[c for c in f.columns if c not in ("full_date", "salary_year_avg", "salary_hour_avg")],
                    F.col("full_date").cast("string").alias("full_date"), _dbl("salary_year_avg"),
                    _dbl("salary_hour_avg"))


def q_star_bridge_skills(spark, sf):
    return H.star_bridge_skills(_m(spark, sf).bridge)


def _customer_snapshot(orders: DataFrame, before: str | None = None) -> DataFrame:
    """Per customer: priority and status of the last order (placed before ``before``)."""
    last = F.max_by(F.struct("o_orderpriority", "o_orderstatus"), F.struct("o_orderdate", "o_orderkey"))
    known = orders if before is None else orders.where(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
    return (known.groupBy(F.col("o_custkey").alias("c_custkey")).agg(last.alias("l"))
            .select("c_custkey", F.col("l.o_orderpriority").alias("last_priority"),
                    F.col("l.o_orderstatus").alias("last_status")))


def q_scd_dimension(spark, sf):
    o = _m(spark, sf).table("orders")
    current = _customer_snapshot(o, SCD_FIRST).select(
        "*", F.lit(SCD_FIRST).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"))
    incoming = _customer_snapshot(o)
    out = SCD.scd_dimension(current, incoming, ["c_custkey"], ["last_priority", "last_status"], SCD_SECOND)
    return out.select("c_custkey", "last_priority", "last_status", F.col("valid_from").cast("string").alias("valid_from"),
                      F.col("valid_to").cast("string").alias("valid_to"), "is_current", "change")


def _order_observations(orders: DataFrame) -> DataFrame:
    """What each order tells about its customer, at the order's date."""
    return orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status"),
                         F.substring("o_orderpriority", 1, 1).alias("priority"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"),
                         F.col("o_orderkey").alias("arrival"))


def q_scd_history(spark, sf):
    """Versions of every customer over all order dates, one pass over all orders."""
    h = SCD.history(_order_observations(_m(spark, sf).table("orders")), ["c_custkey"], ["status", "priority"], "at", "arrival")
    return h.select("c_custkey", "status", "priority", _ts("valid_from"), _ts("valid_to"), "is_current")


def q_fact_as_of(spark, sf):
    """Every line item with its customer's version valid at the ship date."""
    m = _m(spark, sf)
    orders = m.table("orders")
    versions = SCD.history(_order_observations(orders), ["c_custkey"], ["status", "priority"], "at", "arrival")
    lines = m.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "o_custkey", F.date_sub(F.col("l_shipdate").cast("date"), 60).alias("at"))
    out = SCD.as_of(lines, versions, {"o_custkey": "c_custkey"}, "at", ["status", "priority", "valid_from"])
    return out.select("l_orderkey", "l_linenumber", "o_custkey", "status", "priority", _ts("valid_from"))


def q_carry_keys(spark, sf):
    """Companies of the later postings, after a first load of the earlier ones: known members keep their keys."""
    s = _m(spark, sf).staging
    cutoff = F.lit(EARLY_CUTOFF).cast("timestamp_ntz")
    known = D.dim_companies(s.where(F.col("job_posted_date") < cutoff))
    return K.carry_keys(D.dim_companies(s.where(F.col("job_posted_date") >= cutoff)), known, ["company_name"], "company_id")


def q_skills_by_category(spark, sf):
    m = _m(spark, sf)
    return H.skills_by_category(m.bridge, m.skills, m.categories)


def q_postings_by_location(spark, sf):
    m = _m(spark, sf)
    return H.postings_by_location(m.jobs, m.locations)


def q_postings_by_platform_company(spark, sf):
    m = _m(spark, sf)
    return H.postings_by_platform_company(m.jobs, m.platforms, m.companies)


# ---------------------------------------------------------------------------
# the generic operators on a table without posting shape (events)
# ---------------------------------------------------------------------------

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def q_data_profile_events(spark, sf):
    return Q.data_profile(_m(spark, sf).table("events"), EVENT_COLUMNS)


def q_missing_values_events(spark, sf):
    return Q.missing_values(_m(spark, sf).table("events"), EVENT_COLUMNS)


def q_unique_values_events(spark, sf):
    return Q.unique_values(_m(spark, sf).table("events"), ["user_id", "event_type"])


def q_duplicate_rows_events(spark, sf):
    return Q.duplicate_rows(_m(spark, sf).table("events"), ["user_id", "event_type"])


def q_check_isin_events(spark, sf):
    rule = Q.IsIn("event_type", ("click", "view", "purchase"))
    return Q.find_failures(_m(spark, sf).table("events"), [rule], row_id="event_id", required=[])


def q_page_events(spark, sf):
    e = _m(spark, sf).table("events").select("event_id", "ts", "user_id", "event_type")
    return O.page(e, ["ts", "event_id"], 50, 100).select("event_id", "user_id", "event_type")


def q_page_tied(spark, sf):
    """Two pages of rows that share five order values, by an index of the order; ties go by the other columns."""
    e = _m(spark, sf).table("events").select("event_type", "user_id", "event_id")
    index = O.OrderIndex.build(e, ["event_type"])
    first = index.page(500, 700).withColumn("page", F.lit(1))
    return first.unionByName(index.page(500, 1200).withColumn("page", F.lit(2)))


def q_surrogate_key_events(spark, sf):
    e = _m(spark, sf).table("events").select("event_id", "user_id", "ts")
    return K.dense_key(e, ["user_id", "ts", "event_id"], "event_seq").select("event_id", "event_seq")


def q_star_dim_date_events(spark, sf):
    d = H.star_dim_date(_m(spark, sf).table("events"), "ts")
    return d.select(F.col("full_date").cast("string").alias("full_date"), "year", "quarter", "month", "day",
                    "day_of_week")


def _in_mart_folder(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Run a query with its intermediate tables (key tags) under the mart's own folder."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        mart = Mart.get(spark, sf)
        with scratch_under(spark, f"{mart.base}/_work"):
            return fn(spark, sf)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: _in_mart_folder(fn) for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
