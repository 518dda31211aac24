"""Declared schemas and data rules of the postings mart.

Everything here is plain data: StructTypes of the raw, staging and target tables and
the rule lists the constraint and validation operators consume. Operators take column
names as parameters; these registries only supply the defaults for postings.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's behaviour.
# ---------------------------------------------------------------------------

# The 17 raw posting columns, in file order.
RAW_COLUMNS = [
    "job_title_short", "job_title", "job_location", "job_via", "job_schedule_type",
    "job_work_from_home", "search_location", "job_posted_date", "job_no_degree_mention",
    "job_health_insurance", "job_country", "salary_rate", "salary_year_avg",
    "salary_hour_avg", "company_name", "job_skills", "job_type_skills",
]

# Semi-structured columns: skipped by the duplicate / missing / profile metrics.
SEMI_STRUCTURED = ["job_skills", "job_type_skills"]

# Three-valued flag columns ("true" / "false" / anything else -> NULL).
FLAG_COLUMNS = ["job_work_from_home", "job_no_degree_mention", "job_health_insurance"]

# Allowed salary rates (NULL also allowed).
SALARY_RATES = ["hour", "day", "week", "month", "year"]

# Columns whose distinct count the quality report gives.
KEY_COLUMNS = ["job_title_short", "company_name", "job_country", "job_schedule_type"]

# Default missing-value tokens of the pandas CSV reader (public pandas behaviour).
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Cells the list / dict converters treat as missing before parsing.
EMPTY_LIST_TOKENS = ["", "[]"]
EMPTY_DICT_TOKENS = ["", "{}"]

# Fallback member name used by COALESCE in the dimension and lookup SQL.
UNKNOWN = "Unknown"

# ---------------------------------------------------------------------------
# Table schemas
# ---------------------------------------------------------------------------

RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

MONEY = T.DecimalType(10, 2)

STAGING_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("job_title_short", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("job_location", T.StringType()),
    T.StructField("job_via", T.StringType()),
    T.StructField("job_schedule_type", T.StringType()),
    T.StructField("job_work_from_home", T.BooleanType()),
    T.StructField("search_location", T.StringType()),
    T.StructField("job_posted_date", T.TimestampNTZType()),
    T.StructField("job_no_degree_mention", T.BooleanType()),
    T.StructField("job_health_insurance", T.BooleanType()),
    T.StructField("job_country", T.StringType()),
    T.StructField("salary_rate", T.StringType()),
    T.StructField("salary_year_avg", MONEY),
    T.StructField("salary_hour_avg", MONEY),
    T.StructField("company_name", T.StringType()),
    T.StructField("job_skills", T.ArrayType(T.StringType())),
    T.StructField("job_type_skills", T.StringType()),  # JSON text at rest
])

TARGET_SCHEMAS: dict[str, T.StructType] = {
    "companies": T.StructType([
        T.StructField("company_id", T.LongType(), False),
        T.StructField("company_name", T.StringType(), False),
    ]),
    "locations": T.StructType([
        T.StructField("location_id", T.LongType(), False),
        T.StructField("main_city", T.StringType()),
        T.StructField("main_state_province", T.StringType()),
        T.StructField("country", T.StringType(), False),
        T.StructField("full_location", T.StringType()),
    ]),
    "platforms": T.StructType([
        T.StructField("platform_id", T.LongType(), False),
        T.StructField("platform_name", T.StringType(), False),
    ]),
    "schedule_types": T.StructType([
        T.StructField("schedule_type_id", T.LongType(), False),
        T.StructField("schedule_type_name", T.StringType(), False),
    ]),
    "skill_categories": T.StructType([
        T.StructField("category_id", T.LongType(), False),
        T.StructField("category_name", T.StringType(), False),
    ]),
    "skills": T.StructType([
        T.StructField("skill_id", T.LongType(), False),
        T.StructField("skill_name", T.StringType(), False),
        T.StructField("category_id", T.LongType()),
    ]),
    "jobs": T.StructType([
        T.StructField("job_id", T.LongType(), False),
        T.StructField("job_title", T.StringType()),
        T.StructField("job_title_short", T.StringType()),
        T.StructField("company_id", T.LongType()),
        T.StructField("location_id", T.LongType()),
        T.StructField("platform_id", T.LongType()),
        T.StructField("schedule_type_id", T.LongType()),
        T.StructField("job_work_from_home", T.BooleanType()),
        T.StructField("job_posted_date", T.TimestampNTZType()),
        T.StructField("job_no_degree_mention", T.BooleanType()),
        T.StructField("job_health_insurance", T.BooleanType()),
        T.StructField("salary_rate", T.StringType()),
        T.StructField("salary_year_avg", MONEY),
        T.StructField("salary_hour_avg", MONEY),
        T.StructField("search_location", T.StringType()),
    ]),
    "job_skills": T.StructType([
        T.StructField("job_id", T.LongType(), False),
        T.StructField("skill_id", T.LongType(), False),
    ]),
}

# Children first: the order a full refresh clears tables in.
REFRESH_ORDER = ["job_skills", "jobs", "skills", "skill_categories", "companies", "locations",
                 "platforms", "schedule_types"]

# ---------------------------------------------------------------------------
# Rules
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Unique:
    table: str
    columns: tuple[str, ...]
    nulls_distinct: bool = True


@dataclass(frozen=True)
class ForeignKey:
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class MaxLength:
    table: str
    column: str
    length: int


@dataclass(frozen=True)
class AllowedValues:
    table: str
    column: str
    values: tuple[str, ...] = field(default_factory=tuple)


# NOT NULL columns of the target tables.
NOT_NULL_RULES = [
    NotNull("companies", "company_name"),
    NotNull("locations", "country"),
    NotNull("platforms", "platform_name"),
    NotNull("schedule_types", "schedule_type_name"),
    NotNull("skill_categories", "category_name"),
    NotNull("skills", "skill_name"),
    NotNull("jobs", "job_title"),
    NotNull("jobs", "company_id"),
    NotNull("jobs", "location_id"),
    NotNull("job_skills", "job_id"),
    NotNull("job_skills", "skill_id"),
]

UNIQUE_RULES = [
    Unique("companies", ("company_name",)),
    Unique("locations", ("main_city", "main_state_province", "country", "full_location")),
    Unique("platforms", ("platform_name",)),
    Unique("schedule_types", ("schedule_type_name",)),
    Unique("skill_categories", ("category_name",)),
    Unique("skills", ("skill_name",)),
    Unique("job_skills", ("job_id", "skill_id")),
]

PRIMARY_KEY_RULES = [
    Unique("companies", ("company_id",)), Unique("locations", ("location_id",)), Unique("platforms", ("platform_id",)),
    Unique("schedule_types", ("schedule_type_id",)), Unique("skill_categories", ("category_id",)),
    Unique("skills", ("skill_id",)), Unique("jobs", ("job_id",)),
]

FOREIGN_KEY_RULES = [
    ForeignKey("skills", ("category_id",), "skill_categories", ("category_id",)),
    ForeignKey("jobs", ("company_id",), "companies", ("company_id",)),
    ForeignKey("jobs", ("location_id",), "locations", ("location_id",)),
    ForeignKey("jobs", ("platform_id",), "platforms", ("platform_id",)),
    ForeignKey("jobs", ("schedule_type_id",), "schedule_types", ("schedule_type_id",)),
    ForeignKey("job_skills", ("job_id",), "jobs", ("job_id",)),
    ForeignKey("job_skills", ("skill_id",), "skills", ("skill_id",)),
]

# VARCHAR(n) limits.
LENGTH_RULES = [
    MaxLength("staging", "job_title_short", 255),
    MaxLength("staging", "job_schedule_type", 100),
    MaxLength("staging", "job_country", 100),
    MaxLength("staging", "salary_rate", 20),
    MaxLength("locations", "main_city", 100),
    MaxLength("locations", "main_state_province", 100),
    MaxLength("locations", "country", 100),
    MaxLength("platforms", "platform_name", 200),
    MaxLength("schedule_types", "schedule_type_name", 100),
    MaxLength("skill_categories", "category_name", 50),
    MaxLength("skills", "skill_name", 100),
    MaxLength("jobs", "job_title", 500),
    MaxLength("jobs", "job_title_short", 100),
    MaxLength("jobs", "salary_rate", 20),
]

CHECK_RULES = [AllowedValues("jobs", "salary_rate", tuple(SALARY_RATES))]
