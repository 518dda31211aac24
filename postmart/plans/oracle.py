"""DuckDB reference SQL for every registered query.

Written independently of the Spark code, straight from the source semantics, over the
pre-registered test-table views. ``STG`` is the staging table as common table
expressions; each query appends its own SELECT. Conventions: ids and counts BIGINT,
timestamps and decimals rendered as VARCHAR / DOUBLE, NULLS FIRST where order matters.
"""

from __future__ import annotations

# Raw postings (text cells) plus per-order skill rows, then typed staging.
STG = r"""
WITH li AS (
  SELECT l.l_orderkey AS k, p.p_name, p.p_type, p.p_size
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  UNION ALL
  SELECT o_orderkey, o_orderpriority, NULL, 99 FROM orders WHERE o_orderkey % 11 = 0
),
sk AS (
  SELECT k, list_sort(list(DISTINCT concat(upper(p_name), ' '))) AS job_skills FROM li GROUP BY k
),
tsk AS (
  SELECT DISTINCT k, p_type AS category, p_name AS item FROM li WHERE p_size < 25
),
tcat AS (
  SELECT k, category,
         '[' || string_agg('''' || item || '''', ', ' ORDER BY item) || ']' AS lit,
         '[' || string_agg('"' || item || '"', ',' ORDER BY item) || ']' AS json,
         string_agg(item, '|' ORDER BY item) AS items
  FROM tsk GROUP BY k, category
),
tdl AS (
  SELECT k, '{' || string_agg('''' || category || ''': ' || lit, ', ' ORDER BY category) || '}' AS lit,
         '{' || string_agg('"' || category || '":' || json, ',' ORDER BY category) || '}' AS json
  FROM tcat GROUP BY k
),
raw AS (
  SELECT o.o_orderkey AS id,
   CASE WHEN o.o_orderkey % 97 = 0 THEN NULL WHEN o.o_orderkey % 5 = 0 THEN c.c_mktsegment ELSE lower(c.c_mktsegment) END AS job_title_short,
   CASE WHEN o.o_orderkey % 31 = 0 OR o.o_orderkey % 97 = 0 THEN NULL ELSE concat(c.c_mktsegment, ' ', c.c_name) END AS job_title,
   CASE o.o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN n.n_name WHEN 2 THEN concat(n.n_name, ', ', r.r_name)
     ELSE concat('City ', cast(c.c_custkey % 50 AS VARCHAR), ' , ', n.n_name, ',', r.r_name) END AS job_location,
   CASE o.o_orderkey % 4 WHEN 0 THEN concat('via ', o.o_orderpriority) WHEN 1 THEN concat('Melalui  ', o.o_orderpriority)
     WHEN 2 THEN concat(o.o_orderpriority, ' ') ELSE NULL END AS job_via,
   CASE WHEN o.o_orderkey % 9 = 0 THEN '  ' WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE concat(' ', o.o_orderstatus) END AS job_schedule_type,
   CASE o.o_orderkey % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'FALSE' WHEN 2 THEN '1' WHEN 3 THEN 'false' ELSE NULL END AS job_work_from_home,
   r.r_name AS search_location,
   CASE WHEN o.o_orderkey % 53 = 0 THEN NULL ELSE o.o_orderdate END AS job_posted_date,
   CASE o.o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE NULL END AS job_no_degree_mention,
   CASE o.o_orderkey % 2 WHEN 0 THEN 'TRUE' ELSE 'False' END AS job_health_insurance,
   CASE WHEN o.o_orderkey % 13 = 0 THEN NULL WHEN o.o_orderkey % 17 = 0 THEN 'Unknown' ELSE r.r_name END AS job_country,
   CASE o.o_orderkey % 6 WHEN 0 THEN 'hour' WHEN 1 THEN NULL WHEN 2 THEN 'month' ELSE 'year' END AS salary_rate,
   CASE WHEN o.o_orderkey % 6 = 1 THEN NULL ELSE o.o_totalprice END AS salary_year_avg,
   CASE WHEN o.o_orderkey % 6 = 0 THEN o.o_totalprice / 2080 ELSE NULL END AS salary_hour_avg,
   CASE WHEN o.o_orderkey % 101 = 0 THEN NULL WHEN o.o_orderkey % 103 = 0 THEN '   ' ELSE concat(' ', c.c_name, ' ') END AS company_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
stg AS (
  SELECT raw.id, job_title_short, job_title, job_location, job_via, job_schedule_type,
   CASE WHEN lower(job_work_from_home) = 'true' THEN true WHEN lower(job_work_from_home) = 'false' THEN false END AS job_work_from_home,
   search_location,
   CAST(job_posted_date AS TIMESTAMP) AS job_posted_date,
   CASE WHEN lower(job_no_degree_mention) = 'true' THEN true WHEN lower(job_no_degree_mention) = 'false' THEN false END AS job_no_degree_mention,
   CASE WHEN lower(job_health_insurance) = 'true' THEN true WHEN lower(job_health_insurance) = 'false' THEN false END AS job_health_insurance,
   job_country, salary_rate,
   CAST(salary_year_avg AS DECIMAL(10,2)) AS salary_year_avg,
   CAST(salary_hour_avg AS DECIMAL(10,2)) AS salary_hour_avg,
   company_name, sk.job_skills
  FROM raw LEFT JOIN sk ON sk.k = raw.id
)"""

# Dimensions and fact, as further CTEs after STG.
CLEAN_PLATFORM = r"trim(regexp_replace(job_via, '^(via|melalui)\s+', '', 'i'))"

POSTING_COLUMNS = ("job_title_short, job_work_from_home, job_posted_date, job_no_degree_mention, job_health_insurance, "
                   "salary_rate, salary_year_avg, salary_hour_avg, search_location")


def _facts(name: str, locations: str) -> str:
    """Titled postings with the keys of their dimension members, numbered; ``locations`` names the location dimension."""
    return f"""{name} AS (
  WITH keyed AS (
    SELECT id AS staging_id, ifnull(job_title, job_title_short) AS job_title, {POSTING_COLUMNS},
           trim(ifnull(company_name, 'Unknown')) AS company_name, ifnull(job_country, 'Unknown') AS country,
           ifnull(job_location, 'Unknown') AS full_location, {CLEAN_PLATFORM} AS platform_name,
           trim(job_schedule_type) AS schedule_type_name
    FROM stg WHERE {TITLED}
  )
  SELECT CAST(row_number() OVER numbered AS BIGINT) AS job_id, staging_id, job_title, {POSTING_COLUMNS},
         company_id, location_id, platform_id, schedule_type_id
  FROM keyed LEFT JOIN {locations} USING (country, full_location) LEFT JOIN schedule_types USING (schedule_type_name)
       LEFT JOIN platforms USING (platform_name) LEFT JOIN companies USING (company_name)
  WINDOW numbered AS (ORDER BY staging_id, location_id NULLS FIRST)
)"""


TITLED = "ifnull(job_title, job_title_short) IS NOT NULL"

DIMS = r""",
companies AS (
  SELECT CAST(row_number() OVER (ORDER BY company_name) AS BIGINT) AS company_id, company_name
  FROM (SELECT DISTINCT trim(coalesce(company_name, 'Unknown')) AS company_name FROM stg WHERE trim(company_name) != '')
),
loc_rows AS (
  SELECT CASE WHEN trim(split_part(trim(job_location), ',', 1)) = '' THEN NULL ELSE trim(split_part(trim(job_location), ',', 1)) END AS main_city,
         CASE WHEN len(string_split(trim(job_location), ',')) < 2 OR trim(split_part(trim(job_location), ',', 2)) = '' THEN NULL
              ELSE trim(split_part(trim(job_location), ',', 2)) END AS main_state_province,
         coalesce(job_country, 'Unknown') AS country, coalesce(job_location, 'Unknown') AS full_location,
         job_location AS src_location, job_country AS src_country
  FROM (SELECT DISTINCT job_location, job_country FROM stg)
),
locations AS (
  SELECT CAST(row_number() OVER (ORDER BY country, full_location) AS BIGINT) AS location_id,
         main_city, main_state_province, country, full_location
  FROM (SELECT country, full_location, max(main_city) AS main_city, max(main_state_province) AS main_state_province
        FROM loc_rows GROUP BY country, full_location)
),
locations_ref AS (
  SELECT CAST(row_number() OVER (ORDER BY country, full_location, main_city NULLS FIRST, main_state_province NULLS FIRST,
                                      src_location NULLS FIRST, src_country NULLS FIRST) AS BIGINT) AS location_id,
         main_city, main_state_province, country, full_location
  FROM (SELECT DISTINCT main_city, main_state_province, country, full_location, NULL::VARCHAR AS src_location, NULL::VARCHAR AS src_country
        FROM loc_rows WHERE main_city IS NOT NULL AND main_state_province IS NOT NULL
        UNION ALL
        SELECT main_city, main_state_province, country, full_location, src_location, src_country
        FROM loc_rows WHERE main_city IS NULL OR main_state_province IS NULL)
),
platforms AS (
  SELECT CAST(row_number() OVER (ORDER BY platform_name) AS BIGINT) AS platform_id, platform_name
  FROM (SELECT DISTINCT trim(regexp_replace(job_via, '^(via|melalui)\s+', '', 'i')) AS platform_name
        FROM stg WHERE job_via IS NOT NULL AND trim(job_via) <> '')
),
schedule_types AS (
  SELECT CAST(row_number() OVER (ORDER BY schedule_type_name) AS BIGINT) AS schedule_type_id, schedule_type_name
  FROM (SELECT DISTINCT trim(job_schedule_type) AS schedule_type_name FROM stg
        WHERE job_schedule_type IS NOT NULL AND trim(job_schedule_type) != '')
),
skill_categories AS (
  SELECT CAST(row_number() OVER (ORDER BY category_name) AS BIGINT) AS category_id, category_name
  FROM (SELECT DISTINCT category AS category_name FROM tsk)
),
skill_src AS (
  SELECT trim(lower(item)) AS skill_name, category AS category_name FROM tsk WHERE item IS NOT NULL AND item <> ''
  UNION ALL
  SELECT trim(lower(s)) AS skill_name, NULL AS category_name FROM (SELECT unnest(job_skills) AS s FROM stg) WHERE s IS NOT NULL
),
skills AS (
  SELECT CAST(row_number() OVER (ORDER BY m.skill_name) AS BIGINT) AS skill_id, m.skill_name, c.category_id
  FROM (SELECT skill_name, min(category_name) AS category_name FROM skill_src GROUP BY skill_name) m
  LEFT JOIN skill_categories c ON c.category_name = m.category_name
),
{facts},
stg_items AS (
  SELECT s.id, s.job_title, s.job_posted_date, k.skill_id
  FROM (SELECT id, job_title, job_posted_date, unnest(job_skills) AS s_name FROM stg) s
  JOIN skills k ON lower(trim(s.s_name)) = lower(k.skill_name)
),
job_skills AS (
  SELECT DISTINCT j.job_id, i.skill_id
  FROM jobs j JOIN stg_items i ON j.job_title = i.job_title AND j.job_posted_date = i.job_posted_date
),
job_skills_id AS (
  SELECT DISTINCT j.job_id, i.skill_id FROM jobs j JOIN stg_items i ON j.staging_id = i.id
)"""

FULL = STG + DIMS.replace("{facts}", ",\n".join([_facts("jobs", "locations"), _facts("jobs_ref", "locations_ref")]))


def with_mart(select_sql: str) -> str:
    """Full CTE chain + the given final SELECT."""
    return FULL + "\n" + select_sql


# ---------------------------------------------------------------------------
# helpers for repeated shapes
# ---------------------------------------------------------------------------

from ..schemas import KEY_COLUMNS, PANDAS_NA_TOKENS, RAW_COLUMNS, SALARY_RATES, SEMI_STRUCTURED  # noqa: E402

PROFILE_COLUMNS = [c for c in RAW_COLUMNS if c not in SEMI_STRUCTURED]


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _in_list(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _pct(n: str, total: str, digits: int) -> str:
    scale = 10 ** digits
    return (f"CASE WHEN {total} > 0 THEN CAST((({n}) * {200 * scale} + ({total})) // (2 * ({total})) AS DOUBLE)"
            f" / {float(scale)} END")


CITY = ("CASE WHEN trim(split_part(trim(job_location), ',', 1)) = '' THEN NULL "
        "ELSE trim(split_part(trim(job_location), ',', 1)) END")
STATE = ("CASE WHEN trim(split_part(trim(job_location), ',', 2)) = '' THEN NULL "
         "ELSE trim(split_part(trim(job_location), ',', 2)) END")

LIST_LIT = ("CASE WHEN sk.job_skills IS NULL THEN NULL ELSE "
            "'[' || array_to_string(list_transform(sk.job_skills, lambda x: '''' || x || ''''), ', ') || ']' END")

FACT_SELECT = ("job_id, job_title, job_title_short, company_id, location_id, platform_id, schedule_type_id, "
               "job_work_from_home, CAST(job_posted_date AS VARCHAR) AS job_posted_date, job_no_degree_mention, "
               "job_health_insurance, salary_rate, CAST(salary_year_avg AS DOUBLE) AS salary_year_avg, "
               "CAST(salary_hour_avg AS DOUBLE) AS salary_hour_avg, search_location")

ITEMS = "(SELECT id, job_title, job_posted_date, unnest(job_skills) AS s_name FROM stg)"

STAR_LOC = """,
sloc AS (
  SELECT CAST(row_number() OVER (ORDER BY country NULLS FIRST, state_province NULLS FIRST, city NULLS FIRST) AS BIGINT)
           AS location_key, city, state_province, country
  FROM (SELECT DISTINCT main_city AS city, main_state_province AS state_province, country FROM locations)
),
lmap AS (
  SELECT l.location_id, s.location_key FROM locations l JOIN sloc s
    ON l.main_city IS NOT DISTINCT FROM s.city AND l.main_state_province IS NOT DISTINCT FROM s.state_province
   AND l.country = s.country
),
titles AS (
  SELECT CAST(row_number() OVER (ORDER BY job_title_short) AS BIGINT) AS title_key, job_title_short
  FROM (SELECT DISTINCT job_title_short FROM jobs WHERE job_title_short IS NOT NULL)
),
sc AS (SELECT job_id, count(*) AS n FROM job_skills GROUP BY job_id),
sfact AS (
  SELECT j.job_id AS job_key, j.company_id AS company_key, m.location_key,
         CAST(CAST(j.job_posted_date AS DATE) AS VARCHAR) AS full_date,
         j.platform_id AS platform_key, j.schedule_type_id AS schedule_key, t.title_key,
         CAST(1 + 4 * CAST(coalesce(j.job_work_from_home, false) AS INTEGER)
                + 2 * CAST(NOT coalesce(j.job_no_degree_mention, false) AS INTEGER)
                + CAST(coalesce(j.job_health_insurance, false) AS INTEGER) AS BIGINT) AS attributes_key,
         CAST(j.salary_year_avg AS DOUBLE) AS salary_year_avg, CAST(j.salary_hour_avg AS DOUBLE) AS salary_hour_avg,
         CAST(coalesce(sc.n, 0) AS BIGINT) AS skill_count,
         CAST(coalesce(j.job_work_from_home, false) AS INTEGER) AS is_remote,
         CAST(NOT coalesce(j.job_no_degree_mention, false) AS INTEGER) AS has_degree_requirement,
         CAST(coalesce(j.job_health_insurance, false) AS INTEGER) AS has_health_insurance,
         CAST(datediff('day', CAST(j.job_posted_date AS DATE), DATE '1999-01-01') AS INTEGER) AS days_since_posted
  FROM jobs j LEFT JOIN lmap m ON j.location_id = m.location_id
  LEFT JOIN titles t ON j.job_title_short = t.job_title_short
  LEFT JOIN sc ON sc.job_id = j.job_id
)"""


def _snapshot(name: str, before: str | None = None) -> str:
    until = f"WHERE o_orderdate < TIMESTAMP '{before}'" if before else ""
    return f"""{name} AS (
  SELECT c_custkey, last_priority, last_status FROM (
    SELECT o_custkey AS c_custkey, o_orderpriority AS last_priority, o_orderstatus AS last_status,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders {until}) WHERE rn = 1)"""


# ---------------------------------------------------------------------------
# the oracle per query
# ---------------------------------------------------------------------------

def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    text_cols = [c for c in RAW_COLUMNS if c not in ("salary_year_avg", "salary_hour_avg", "job_posted_date")
                 + tuple(SEMI_STRUCTURED)]
    o["scan_csv"] = STG + f"""
SELECT {', '.join('raw.' + c for c in text_cols)}, CAST(raw.job_posted_date AS VARCHAR) AS job_posted_date,
       {LIST_LIT} AS job_skills, tdl.lit AS job_type_skills,
       CAST(raw.salary_year_avg AS DOUBLE) AS salary_year_avg, CAST(raw.salary_hour_avg AS DOUBLE) AS salary_hour_avg
FROM raw LEFT JOIN sk ON sk.k = raw.id LEFT JOIN tdl ON tdl.k = raw.id"""
    toks = _in_list(PANDAS_NA_TOKENS + ["  ", "   ", "1"])
    o["null_tokens"] = STG + "\nSELECT id, " + ", ".join(
        f"CASE WHEN {c} IN {toks} THEN NULL ELSE {c} END AS {c}"
        for c in ("job_schedule_type", "job_work_from_home", "company_name", "job_via")) + (
        " FROM (SELECT id, job_schedule_type, job_work_from_home, company_name, CASE WHEN id % 61 = 0 THEN 'NA' "
        "WHEN id % 67 = 0 THEN 'n/a' WHEN id % 71 = 0 THEN '-1.#IND' ELSE job_via END AS job_via FROM raw)")
    o["staging_scan"] = STG + """
SELECT id, job_title_short, job_title, job_location, job_via, job_schedule_type, job_work_from_home, search_location,
       CAST(job_posted_date AS VARCHAR) AS job_posted_date, job_no_degree_mention, job_health_insurance, job_country,
       salary_rate, CAST(salary_year_avg AS DOUBLE) AS salary_year_avg, CAST(salary_hour_avg AS DOUBLE) AS salary_hour_avg,
       company_name, CASE WHEN job_skills IS NULL THEN NULL ELSE array_to_string(job_skills, '|') END AS job_skills
FROM stg"""
    list_q = STG + """
SELECT raw.id, CAST(len(sk.job_skills) AS BIGINT) AS n_items,
       CASE WHEN sk.job_skills IS NULL THEN NULL ELSE array_to_string(sk.job_skills, '|') END AS items
FROM raw LEFT JOIN sk ON sk.k = raw.id"""
    o["parse_list"] = list_q
    o["normalize_list"] = list_q.replace("FROM raw LEFT JOIN sk ON sk.k = raw.id",
                                         "FROM raw LEFT JOIN sk ON sk.k = raw.id AND raw.id % 83 <> 0 AND raw.id % 79 <> 0")
    o["parse_dict"] = STG + "\nSELECT tcat.k AS id, category, items FROM tcat JOIN raw ON raw.id = tcat.k"
    o["encode_json"] = STG + """
SELECT id, json FROM (
  SELECT raw.id, CASE WHEN raw.id % 89 = 0 OR raw.id % 71 = 0 THEN NULL
                      WHEN raw.id % 67 = 0 THEN '{"l":[1,true,null],"mixed":"text","n":3}' ELSE tdl.json END AS json
  FROM raw LEFT JOIN tdl ON tdl.k = raw.id) WHERE json IS NOT NULL"""
    o["tri_state_bool"] = STG + "\nSELECT id, job_work_from_home, job_no_degree_mention, job_health_insurance FROM stg"
    o["to_timestamp"] = STG + "\nSELECT id, CAST(job_posted_date AS VARCHAR) AS job_posted_date FROM stg"
    o["to_decimal"] = STG + """
SELECT id, CAST(salary_year_avg AS DOUBLE) AS salary_year_avg, CAST(salary_hour_avg AS DOUBLE) AS salary_hour_avg FROM stg"""
    o["create_row_id"] = STG + """
SELECT CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS id, job_title, company_name FROM raw"""

    # validation and quality
    year = ("CASE WHEN id % 41 = 0 THEN 'abc' WHEN id % 43 = 0 THEN '-5' WHEN id % 47 = 0 THEN '1.0d' "
            "WHEN id % 59 = 0 THEN '123456789012' ELSE CAST(salary_year_avg AS VARCHAR) END")
    hour = ("CASE WHEN id % 41 = 0 THEN '5f' WHEN id % 43 = 0 THEN '-0.5' WHEN id % 59 = 0 THEN '1e9' "
            "ELSE CAST(salary_hour_avg AS VARCHAR) END")
    parts = []
    for check, failing in (("coerce_dtype", "{c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL"),
                           ("numeric_range", "abs(TRY_CAST({c} AS DOUBLE)) >= 99999999.995"),
                           ("greater_than_or_equal_to", "TRY_CAST({c} AS DOUBLE) < 0")):
        parts += [f"SELECT '{check}' AS \"check\", '{c}' AS column_name, "
                  f"CAST(count(*) FILTER (WHERE {failing.format(c=c)}) AS BIGINT) AS failures FROM cells"
                  for c in ("salary_year_avg", "salary_hour_avg")]
    parts.append("SELECT 'isin', 'salary_rate', CAST(count(*) FILTER (WHERE salary_rate NOT IN "
                 "('hour', 'day', 'week', 'month', 'year')) AS BIGINT) FROM cells")
    parts += [f"SELECT 'column_in_dataframe', '{c}', CAST({int(c == 'search_location')} AS BIGINT)" for c in RAW_COLUMNS]
    o["validate_schema"] = STG + f""",
cells AS (SELECT {year} AS salary_year_avg, {hour} AS salary_hour_avg,
                 CASE WHEN id % 37 = 0 THEN 'century' ELSE salary_rate END AS salary_rate FROM raw)
""" + _union(parts)
    o["check_isin"] = """
SELECT 'isin' AS "check", 'o_orderstatus' AS column_name, o_orderkey AS row_id, o_orderstatus AS value
FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')"""
    o["check_min"] = """
SELECT 'greater_than_or_equal_to' AS "check", 'c_acctbal' AS column_name, c_custkey AS row_id,
       CAST(c_acctbal AS VARCHAR) AS value
FROM customer WHERE c_acctbal < 0"""
    o["row_count"] = STG + "\nSELECT CAST(count(*) AS BIGINT) AS total_rows FROM stg"
    o["duplicate_rows"] = STG + f"""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM raw GROUP BY {', '.join(KEY_COLUMNS)})"""
    o["missing_values"] = STG + "\n" + _union([
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_count, "
        f"{_pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)', 2)} AS missing_pct FROM raw"
        for c in PROFILE_COLUMNS])
    o["unique_values"] = STG + "\n" + _union([
        f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count FROM raw"
        for c in KEY_COLUMNS])
    lists = STG + """,
cells AS (
  SELECT raw.id, CASE WHEN raw.id % 89 = 0 OR raw.id % 83 = 0 THEN 'invalid' WHEN raw.id % 79 = 0 THEN 'x|None'
                      ELSE array_to_string(sk.job_skills, '|') END AS items
  FROM raw LEFT JOIN sk ON sk.k = raw.id
)"""
    o["list_structure"] = lists + """
SELECT CAST(count(items) AS BIGINT) AS total_non_null, CAST(count(*) FILTER (WHERE items <> 'invalid') AS BIGINT) AS valid_lists,
       CAST(count(*) FILTER (WHERE items = 'invalid') AS BIGINT) AS invalid,
       CAST(count(*) FILTER (WHERE items = 'x|None') AS BIGINT) AS null_items FROM cells"""
    o["list_samples"] = lists + "\nSELECT id, items FROM cells WHERE items <> 'invalid' ORDER BY id LIMIT 10"
    dicts = STG + """,
cells AS (
  SELECT raw.id, CASE WHEN raw.id % 89 = 0 OR raw.id % 71 = 0 THEN 'invalid' WHEN raw.id % 67 = 0 THEN 'mixed'
                      WHEN tdl.k IS NOT NULL THEN 'plain' END AS kind
  FROM raw LEFT JOIN tdl ON tdl.k = raw.id
)"""
    o["dict_structure"] = dicts + """
SELECT CAST(count(kind) AS BIGINT) AS total_non_null, CAST(count(*) FILTER (WHERE kind <> 'invalid') AS BIGINT) AS valid_dicts,
       CAST(count(*) FILTER (WHERE kind = 'invalid') AS BIGINT) AS invalid FROM cells"""
    o["dict_categories"] = dicts + """
SELECT category, CAST(count(*) AS BIGINT) AS n_cells FROM (
  SELECT tcat.category FROM tcat JOIN cells ON cells.id = tcat.k WHERE kind = 'plain'
  UNION ALL SELECT unnest(['n', 'mixed', 'l']) FROM cells WHERE kind = 'mixed') GROUP BY category"""
    types = {c: "string" for c in PROFILE_COLUMNS}
    types.update({"salary_year_avg": "double", "salary_hour_avg": "double"})
    o["data_profile"] = STG + "\n" + _union([
        f"SELECT '{c}' AS column_name, '{types[c]}' AS data_type, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
        f"{_pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)', 1)} AS null_pct, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count, CAST(count(*) AS BIGINT) AS n_rows, "
        f"CAST({len(RAW_COLUMNS) + 1} AS BIGINT) AS n_columns FROM raw"
        for c in PROFILE_COLUMNS])

    # dimensions and keys
    o["dim_companies"] = with_mart("SELECT company_id, company_name FROM companies")
    o["parse_location"] = STG + f"""
SELECT job_location, {CITY} AS main_city, {STATE} AS main_state_province FROM (SELECT DISTINCT job_location FROM stg)"""
    o["dim_locations"] = with_mart("SELECT * FROM locations")
    o["dim_locations_ref"] = with_mart("SELECT * FROM locations_ref")
    o["dim_platforms"] = with_mart("SELECT * FROM platforms")
    o["dim_schedule_types"] = with_mart("SELECT * FROM schedule_types")
    o["dim_skill_categories"] = with_mart("SELECT * FROM skill_categories")
    o["dim_skills_categorized"] = STG + """
SELECT trim(lower(item)) AS skill_name, min(category) AS category_name FROM tsk WHERE item <> '' GROUP BY 1"""
    o["dim_skills_uncategorized"] = STG + """
SELECT DISTINCT trim(lower(s)) AS skill_name FROM (SELECT unnest(job_skills) AS s FROM stg)
WHERE s IS NOT NULL AND trim(lower(s)) NOT IN (SELECT trim(lower(item)) FROM tsk WHERE item <> '')"""
    o["dim_skills"] = with_mart("SELECT skill_id, skill_name, category_id FROM skills")
    o["map_category_id"] = with_mart("""
SELECT m.skill_name, m.category_name, c.category_id
FROM (SELECT skill_name, min(category_name) AS category_name FROM skill_src GROUP BY skill_name) m
LEFT JOIN skill_categories c USING (category_name)""")
    o["surrogate_key"] = """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS BIGINT) AS order_seq
FROM orders"""
    o["insert_if_absent"] = STG + """,
early AS (
  SELECT CAST(row_number() OVER (ORDER BY company_name) AS BIGINT) AS company_id, company_name
  FROM (SELECT DISTINCT trim(coalesce(company_name, 'Unknown')) AS company_name FROM stg
        WHERE trim(company_name) != '' AND job_posted_date < TIMESTAMP '1995-01-01')
),
later AS (
  SELECT DISTINCT trim(coalesce(company_name, 'Unknown')) AS company_name FROM stg
  WHERE trim(company_name) != '' AND trim(coalesce(company_name, 'Unknown')) NOT IN (SELECT company_name FROM early)
)
SELECT company_id, company_name FROM early
UNION ALL
SELECT CAST((SELECT coalesce(max(company_id), 0) FROM early) + row_number() OVER (ORDER BY company_name) AS BIGINT),
       company_name FROM later"""

    # projections and lookups
    o["coalesce_title"] = STG + "\nSELECT id, coalesce(job_title, job_title_short) AS job_title FROM stg"
    o["filter_titled"] = STG + f"\nSELECT id FROM stg WHERE {TITLED}"
    o["blank_filter"] = STG + "\nSELECT id, company_name FROM stg WHERE trim(company_name) != ''"
    o["default_unknown"] = STG + """
SELECT id, coalesce(job_country, 'Unknown') AS country, coalesce(job_location, 'Unknown') AS full_location FROM stg"""
    o["fact_projection"] = STG + f"""
SELECT id, coalesce(job_title, job_title_short) AS job_title, job_title_short, job_work_from_home,
       CAST(job_posted_date AS VARCHAR) AS job_posted_date, job_no_degree_mention, job_health_insurance, salary_rate,
       CAST(salary_year_avg AS DOUBLE) AS salary_year_avg, CAST(salary_hour_avg AS DOUBLE) AS salary_hour_avg,
       search_location
FROM stg WHERE {TITLED}"""
    o["text_normalize"] = STG + """
SELECT DISTINCT id, lower(trim(s)) AS skill_key FROM (SELECT id, unnest(job_skills) AS s FROM stg)"""
    titled = f"(SELECT * FROM stg WHERE {TITLED})"
    o["lookup_company"] = with_mart(f"""
SELECT id, company_id FROM (SELECT id, trim(ifnull(company_name, 'Unknown')) AS company_name FROM {titled})
LEFT JOIN companies USING (company_name)""")
    o["lookup_location"] = with_mart(f"""
SELECT id, location_id FROM (SELECT id, ifnull(job_country, 'Unknown') AS country, ifnull(job_location, 'Unknown') AS full_location
                             FROM {titled}) LEFT JOIN locations USING (country, full_location)""")
    o["lookup_platform"] = with_mart(f"""
SELECT id, platform_id FROM (SELECT id, {CLEAN_PLATFORM} AS platform_name FROM {titled}) LEFT JOIN platforms USING (platform_name)""")
    o["lookup_schedule"] = with_mart(f"""
SELECT id, schedule_type_id FROM (SELECT id, trim(job_schedule_type) AS schedule_type_name FROM {titled})
LEFT JOIN schedule_types USING (schedule_type_name)""")
    o["fact_jobs"] = with_mart(f"SELECT {FACT_SELECT} FROM jobs")
    o["fact_jobs_ref"] = with_mart(f"SELECT {FACT_SELECT} FROM jobs_ref")

    # bridge, aggregates, order
    o["rejoin_staging"] = with_mart("""
SELECT job_title, CAST(job_posted_date AS VARCHAR) AS job_posted_date, CAST(count(DISTINCT job_id) AS BIGINT) AS n_jobs,
       CAST(count(DISTINCT id) AS BIGINT) AS n_staging, CAST(count(*) AS BIGINT) AS n_pairs
FROM (SELECT job_id, job_title, job_posted_date FROM jobs) JOIN (SELECT id, job_title, job_posted_date FROM stg)
     USING (job_title, job_posted_date) GROUP BY 1, 2""")
    o["explode_skills"] = STG + "\nSELECT id, unnest(job_skills) AS s_name FROM stg"
    o["match_skill"] = with_mart(f"""
SELECT i.id, i.s_name, k.skill_id FROM {ITEMS} i JOIN skills k ON lower(trim(i.s_name)) = lower(k.skill_name)""")
    o["bridge_job_skills"] = with_mart("SELECT job_id, skill_id FROM job_skills")
    o["bridge_job_skills_id"] = with_mart("SELECT job_id, skill_id FROM job_skills_id")
    o["count_eligible"] = STG + f"\nSELECT CAST(count(*) AS BIGINT) AS eligible_rows FROM stg WHERE {TITLED}"
    o["count_bridge"] = with_mart("""
SELECT CAST(count(*) AS BIGINT) AS bridge_rows_before_dedupe
FROM jobs j JOIN stg_items i ON j.job_title = i.job_title AND j.job_posted_date = i.job_posted_date""")
    o["distinct_values"] = STG + "\nSELECT DISTINCT job_location, job_country FROM stg"
    o["infer_timestamp"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d 00:00:00') END AS a,
       CASE WHEN o_orderkey % 70 <> 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d 00:00:00') END AS b FROM orders"""
    o["page_tied"] = """
SELECT event_type, user_id, event_id, CASE WHEN place <= 1200 THEN 1 ELSE 2 END AS page
FROM (SELECT event_type, user_id, event_id, row_number() OVER (ORDER BY event_type NULLS FIRST, user_id NULLS FIRST, event_id NULLS FIRST) AS place
      FROM events) WHERE place > 700 AND place <= 1700"""
    versions = """
WITH seen AS (SELECT o_custkey AS c_custkey, CAST(o_orderdate AS TIMESTAMP) AS seen_at, arg_max(o_orderstatus, o_orderkey) AS status,
                     arg_max(substr(o_orderpriority, 1, 1), o_orderkey) AS priority FROM orders GROUP BY ALL),
marked AS (SELECT *, lag(status) OVER w IS DISTINCT FROM status OR lag(priority) OVER w IS DISTINCT FROM priority
                     OR row_number() OVER w = 1 AS starts FROM seen WINDOW w AS (PARTITION BY c_custkey ORDER BY seen_at)),
versions AS (SELECT c_custkey, status, priority, seen_at AS valid_from, lead(seen_at) OVER (PARTITION BY c_custkey ORDER BY seen_at) AS valid_to
             FROM marked WHERE starts)"""
    o["scd_history"] = versions + """
SELECT c_custkey, status, priority, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from,
       strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to, valid_to IS NULL AS is_current FROM versions"""
    o["fact_as_of"] = versions + """,
lines AS (SELECT l_orderkey, l_linenumber, o_custkey, CAST(CAST(l_shipdate AS DATE) - 60 AS TIMESTAMP) AS ship_at
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, o_custkey, status, priority, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from
FROM lines ASOF LEFT JOIN versions ON o_custkey = c_custkey AND lines.ship_at >= versions.valid_from"""
    o["carry_keys"] = STG + """,
names AS (SELECT trim(company_name) AS name, job_posted_date < TIMESTAMP '1995-01-01' AS early FROM stg
          WHERE trim(company_name) <> '' AND job_posted_date IS NOT NULL),
known AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM (SELECT DISTINCT name FROM names WHERE early)),
late AS (SELECT DISTINCT name FROM names WHERE NOT early)
SELECT coalesce(known.id, (SELECT count(*) FROM known) + row_number() OVER (PARTITION BY known.id IS NULL ORDER BY late.name)) AS company_id,
       late.name AS company_name FROM late LEFT JOIN known USING (name)"""
    o["batch_profile"] = """
SELECT column_name, CAST(0 AS BIGINT) AS null_count, 0.0 AS null_pct, unique_count, n_rows
FROM (SELECT count(*) AS n_rows, count(DISTINCT o_orderstatus) AS s, count(DISTINCT o_orderpriority) AS p, count(DISTINCT o_orderdate) AS d
      FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')),
     LATERAL (VALUES ('o_orderstatus', s), ('o_orderpriority', p), ('o_orderdate', d)) v(column_name, unique_count)"""
    o["distinct_jsonb"] = """SELECT DISTINCT '{"flag":["' || l_returnflag || '"],"n":' || CAST(l_linenumber AS VARCHAR) || '}' AS document
FROM lineitem"""
    o["literal_cells"] = """
WITH p AS (SELECT p_partkey, p_partkey % 7 AS r, p_name AS name FROM part)
SELECT p_partkey, CASE WHEN r < 5 THEN 'n' END AS key,
       CASE r WHEN 0 THEN name || '|x' WHEN 1 THEN name || '|it''s' WHEN 2 THEN name || 'é' || chr(9) || 'A|None|True|7|-1.5'
              WHEN 4 THEN name END AS items FROM p
UNION ALL SELECT p_partkey, 'm', NULL FROM p WHERE r = 3"""
    o["distinct_json"] = STG + "\nSELECT DISTINCT tdl.json AS job_type_skills FROM tdl JOIN raw ON raw.id = tdl.k"
    o["set_union"] = STG + "\nSELECT DISTINCT category AS category_name, trim(lower(item)) AS skill_name FROM tsk"
    o["pair_dedupe"] = with_mart(f"""
SELECT DISTINCT i.id, k.skill_id FROM {ITEMS} i JOIN skills k ON lower(trim(i.s_name)) = lower(k.skill_name)""")
    o["order_by_id"] = STG + "\nSELECT id, job_title, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS position FROM stg"
    o["order_by_pair"] = with_mart("SELECT job_id, skill_id, CAST(row_number() OVER (ORDER BY job_id, skill_id) AS BIGINT) "
                                   "AS position FROM job_skills")
    o["page"] = with_mart("SELECT job_id, job_title, company_id FROM jobs ORDER BY job_id LIMIT 10000 OFFSET 10000")
    o["head_n"] = STG + "\nSELECT id, job_title, company_name FROM stg ORDER BY id LIMIT 10"

    # constraints
    o["check_not_null"] = with_mart(_union([
        f"SELECT 'jobs' AS table_name, '{c}' AS column_name, job_id AS row_key FROM jobs WHERE {c} IS NULL"
        for c in ("job_title", "company_id", "location_id")]))
    o["check_unique"] = with_mart("""
SELECT country, full_location, CAST(count(*) AS BIGINT) AS n_rows FROM locations_ref
WHERE country IS NOT NULL AND full_location IS NOT NULL GROUP BY country, full_location HAVING count(*) > 1""")
    # Each query breaks its rule in every third row; the limits are written out here.
    o["check_foreign_key"] = with_mart(_union([
        f"SELECT '{child}' AS table_name, '{c}' AS column_name, '{parent}' AS parent_table, CAST(count(*) AS BIGINT) AS violations "
        f"FROM (SELECT CASE WHEN {key} % 3 = 0 THEN -abs({c}) ELSE {c} END AS k FROM {child}) "
        f"WHERE k IS NOT NULL AND k NOT IN (SELECT {c} FROM {parent})"
        for child, key, c, parent in (
            ("skills", "skill_id", "category_id", "skill_categories"), ("jobs", "job_id", "company_id", "companies"),
            ("jobs", "job_id", "location_id", "locations"), ("jobs", "job_id", "platform_id", "platforms"),
            ("jobs", "job_id", "schedule_type_id", "schedule_types"), ("job_skills", "job_id", "job_id", "jobs"),
            ("job_skills", "job_id", "skill_id", "skills"))]))
    o["check_expression"] = with_mart("""
SELECT 'jobs' AS table_name, 'salary_rate' AS column_name, CAST(count(*) FILTER (
  WHERE CASE WHEN job_id % 3 = 0 THEN 'century' ELSE salary_rate END NOT IN ('hour', 'day', 'week', 'month', 'year')) AS BIGINT)
  AS violations FROM jobs""")
    o["check_length"] = with_mart(_union([
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST({n} AS BIGINT) AS max_length, "
        f"CAST(count(*) FILTER (WHERE {key} % 3 = 0 OR length({c}) > {n}) AS BIGINT) AS violations FROM {view}"
        for table, view, key, c, n in (
            ("staging", "stg", "id", "job_title_short", 255), ("staging", "stg", "id", "job_schedule_type", 100),
            ("staging", "stg", "id", "job_country", 100), ("staging", "stg", "id", "salary_rate", 20),
            ("locations", "locations", "location_id", "main_city", 100),
            ("locations", "locations", "location_id", "main_state_province", 100),
            ("locations", "locations", "location_id", "country", 100),
            ("platforms", "platforms", "platform_id", "platform_name", 200),
            ("schedule_types", "schedule_types", "schedule_type_id", "schedule_type_name", 100),
            ("skill_categories", "skill_categories", "category_id", "category_name", 50),
            ("skills", "skills", "skill_id", "skill_name", 100), ("jobs", "jobs", "job_id", "job_title", 500),
            ("jobs", "jobs", "job_id", "job_title_short", 100), ("jobs", "jobs", "job_id", "salary_rate", 20))]))
    o["cascade_delete"] = with_mart("""
SELECT job_id, skill_id FROM job_skills WHERE job_id NOT IN (SELECT job_id FROM jobs WHERE company_id IS NULL)""")

    # star schema
    o["star_dim_company"] = with_mart("""
SELECT company_id AS company_key, company_name, NULL::VARCHAR AS company_size, NULL::VARCHAR AS industry FROM companies""")
    o["star_dim_location"] = with_mart(STAR_LOC + "\nSELECT * FROM sloc")
    o["star_dim_date"] = with_mart("""
SELECT CAST(d AS VARCHAR) AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week
FROM (SELECT CAST(unnest(generate_series(min(CAST(job_posted_date AS DATE)), max(CAST(job_posted_date AS DATE)),
                                         INTERVAL 1 DAY)) AS DATE) AS d FROM jobs)""")
    o["star_dim_job_title"] = with_mart(STAR_LOC + """
SELECT title_key, job_title_short, NULL::VARCHAR AS job_title_category, NULL::VARCHAR AS seniority_level FROM titles""")
    o["star_dim_platform"] = with_mart("""
SELECT platform_id AS platform_key, platform_name, NULL::VARCHAR AS platform_type FROM platforms""")
    o["star_dim_schedule_type"] = with_mart("""
SELECT schedule_type_id AS schedule_key, schedule_type_name, lower(schedule_type_name) LIKE '%full-time%' AS is_full_time
FROM schedule_types""")
    o["star_dim_skill"] = with_mart("""
SELECT s.skill_id AS skill_key, s.skill_name, c.category_name AS skill_category
FROM skills s LEFT JOIN skill_categories c ON s.category_id = c.category_id""")
    o["star_dim_attributes"] = with_mart(STAR_LOC + """,
attr AS (
  SELECT CAST(1 + 4 * CAST(r AS INTEGER) + 2 * CAST(d AS INTEGER) + CAST(h AS INTEGER) AS BIGINT) AS attributes_key,
         r AS is_remote, d AS has_degree_req, h AS has_health_insurance,
         concat_ws(' + ', CASE WHEN r THEN 'Remote' ELSE 'On-site' END, CASE WHEN d THEN 'Degree' ELSE 'No Degree' END,
                   CASE WHEN h THEN 'Health Insurance' ELSE 'No Health Insurance' END) AS attribute_combination_name
  FROM (VALUES (false), (true)) a(r), (VALUES (false), (true)) b(d), (VALUES (false), (true)) c(h)
)
SELECT attr.*, CAST(coalesce(n.n_postings, 0) AS BIGINT) AS n_postings
FROM attr LEFT JOIN (SELECT attributes_key, count(*) AS n_postings FROM sfact GROUP BY attributes_key) n
  ON n.attributes_key = attr.attributes_key""")
    o["star_fact_postings"] = with_mart(STAR_LOC + "\nSELECT * FROM sfact")
    o["star_bridge_skills"] = with_mart("SELECT job_id AS job_key, skill_id AS skill_key FROM job_skills")
    o["scd_dimension"] = ("WITH " + _snapshot("snap1", "1995-01-01") + ",\n" + _snapshot("snap2") + """,
j AS (
  SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, a.last_priority AS cp, a.last_status AS cs,
         b.last_priority AS np, b.last_status AS ns, a.c_custkey IS NOT NULL AS in_cur, b.c_custkey IS NOT NULL AS in_new,
         (a.last_priority IS NOT DISTINCT FROM b.last_priority AND a.last_status IS NOT DISTINCT FROM b.last_status) AS same
  FROM snap1 a FULL OUTER JOIN snap2 b ON a.c_custkey = b.c_custkey
)
SELECT c_custkey, cp AS last_priority, cs AS last_status, '1995-01-01' AS valid_from, NULL::VARCHAR AS valid_to,
       true AS is_current, 'unchanged' AS change FROM j WHERE in_cur AND (NOT in_new OR same)
UNION ALL
SELECT c_custkey, cp, cs, '1995-01-01', '1999-01-01', false, 'closed' FROM j WHERE in_cur AND in_new AND NOT same
UNION ALL
SELECT c_custkey, np, ns, '1999-01-01', NULL, true, 'opened' FROM j WHERE in_cur AND in_new AND NOT same
UNION ALL
SELECT c_custkey, np, ns, '1999-01-01', NULL, true, 'new' FROM j WHERE in_new AND NOT in_cur""")
    o["skills_by_category"] = with_mart("""
SELECT c.category_name, s.skill_name, CAST(GROUPING(c.category_name, s.skill_name) AS INTEGER) AS level,
       CAST(count(DISTINCT b.job_id) AS BIGINT) AS n_postings
FROM job_skills b JOIN skills s ON b.skill_id = s.skill_id LEFT JOIN skill_categories c ON s.category_id = c.category_id
GROUP BY ROLLUP (c.category_name, s.skill_name)""")
    o["postings_by_location"] = with_mart("""
SELECT l.country, l.main_city AS city, CAST(count(*) AS BIGINT) AS n_postings,
       CAST(sum(j.salary_year_avg) AS DOUBLE) AS total_salary_year
FROM jobs j LEFT JOIN locations l ON j.location_id = l.location_id GROUP BY l.country, l.main_city""")
    o["postings_by_platform_company"] = with_mart("""
SELECT p.platform_name, c.company_name, CAST(count(*) AS BIGINT) AS n_postings
FROM jobs j LEFT JOIN platforms p ON j.platform_id = p.platform_id LEFT JOIN companies c ON j.company_id = c.company_id
GROUP BY p.platform_name, c.company_name""")

    # the generic operators on events
    ev = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    ev_types = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
                "value": "double", "props": "string"}
    o["data_profile_events"] = _union([
        f"SELECT '{c}' AS column_name, '{ev_types[c]}' AS data_type, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
        f"{_pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)', 1)} AS null_pct, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count, CAST(count(*) AS BIGINT) AS n_rows, "
        f"CAST({len(ev)} AS BIGINT) AS n_columns FROM events" for c in ev])
    o["missing_values_events"] = _union([
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_count, "
        f"{_pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)', 2)} AS missing_pct FROM events" for c in ev])
    o["unique_values_events"] = _union([
        f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count FROM events"
        for c in ("user_id", "event_type")])
    o["duplicate_rows_events"] = """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type)"""
    o["check_isin_events"] = """
SELECT 'isin' AS "check", 'event_type' AS column_name, event_id AS row_id, event_type AS value
FROM events WHERE event_type IS NOT NULL AND event_type NOT IN ('click', 'view', 'purchase')"""
    o["page_events"] = """
SELECT event_id, user_id, event_type FROM events ORDER BY ts NULLS FIRST, event_id NULLS FIRST LIMIT 50 OFFSET 100"""
    o["surrogate_key_events"] = """
SELECT event_id, CAST(row_number() OVER (ORDER BY user_id NULLS FIRST, ts NULLS FIRST, event_id NULLS FIRST) AS BIGINT)
       AS event_seq FROM events"""
    o["star_dim_date_events"] = """
SELECT CAST(d AS VARCHAR) AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week
FROM (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
      FROM events)"""
    return o


ORACLE = _oracles()
