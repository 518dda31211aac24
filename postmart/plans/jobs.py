"""Whole loads as Spark jobs (L1-L3).

``run_full``: scan -> parse -> validate (gate) -> stage -> 3NF -> checks -> publish.
``run_transform_only``: the same from staging on; staging is not touched.
``run_ingest_only``: scan -> parse -> stage, without validation (as the source's
ingest entry point does).

Nothing is visible to readers until every table of the run is written and checked:
the run folder is published by rewriting the one-line pointer at the end. A failed
run leaves the previous publication in place.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bridge as B
from ..operators import constraints as C
from ..operators import dimensions as D
from ..operators import facts as FX
from ..operators import keys as K
from ..operators import quality as Q
from ..operators import star as H
from ..schemas import (CHECK_RULES, FOREIGN_KEY_RULES, KEY_COLUMNS, LENGTH_RULES, NOT_NULL_RULES, PRIMARY_KEY_RULES,
                       REFRESH_ORDER, SEMI_STRUCTURED, UNIQUE_RULES, AllowedValues, MaxLength, NotNull)
from ..session import fresh_dir, scratch_under
from ..sources import ingest as I
from ..sources import tables as TB


@dataclass
class LoadReport:
    ok: bool
    run_id: str | None = None
    message: str | None = None
    counts: dict[str, int] = field(default_factory=dict)
    violations: dict[str, int] = field(default_factory=dict)
    lost: dict[str, int] = field(default_factory=dict)       # cells that coercion turned into NULL
    quality: str | None = None                               # folder of the quality report, one table per metric


def read_postings_csv(spark: SparkSession, path: str, base: str | None = None, multiline: bool = False) -> DataFrame:
    """CSV -> converted raw postings with ids continuing after the staged ones.

    The numbered text is landed once as Parquet, so that the gate, the quality report and
    staging read that instead of parsing the files again.
    """
    start = 1
    if base is not None and TB.staging_exists(spark, base):
        start = K.max_key(TB.read_table(spark, base, "staging"), "id") + 1
    landed = fresh_dir(spark, "landed")
    # Ids first (no shuffle of the rows), then the literal cells are parsed once.
    I.parse_cells(I.arrival_ids(I.scan_csv(spark, path, multiline=multiline), "id", start)).write.parquet(landed)
    return I.mend_unread(spark.read.parquet(landed))


def quality_report(raw: DataFrame, path: str) -> None:
    """Write the quality metrics of a load (V5-V8, V12 and the structure of the skill cells) under ``path``."""
    marked, raw = raw, raw.drop(*I.PRESENT.values())
    plain = [c for c in raw.columns if c not in SEMI_STRUCTURED and c != "id"]
    metrics = {
        "row_count": lambda: Q.row_count(raw),
        "duplicate_rows": lambda: Q.duplicate_rows(raw, plain),
        "missing_values": lambda: Q.missing_values(raw, plain),
        "unique_values": lambda: Q.unique_values(raw, [c for c in KEY_COLUMNS if c in raw.columns]),
        "data_profile": lambda: Q.data_profile(raw, plain),
        **{f"structure_{c}": (lambda c=c, m=m: Q.parsed_structure(marked, m, c)) for c, m in I.PRESENT.items() if m in marked.columns},
    }
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda m: m[1]().write.mode("overwrite").parquet(f"{path}/{m[0]}"), metrics.items()))


#: Dimension -> (natural key, surrogate key).
DIMENSION_KEYS = {"companies": (["company_name"], "company_id"), "platforms": (["platform_name"], "platform_id"),
                  "locations": (["main_city", "main_state_province", "country", "full_location"], "location_id"),
                  "schedule_types": (["schedule_type_name"], "schedule_type_id"),
                  "skill_categories": (["category_name"], "category_id"), "skills": (["skill_name"], "skill_id")}


def known_keys(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Every (natural key, key) that published loads have given, by dimension; empty before the first."""
    run = TB.current_run(spark, base)
    if run is None:
        return {}
    known = {}
    for name, (natural, key) in DIMENSION_KEYS.items():
        path = TB.run_path(base, run, f"_keys/{name}")
        known[name] = (spark.read.parquet(path) if TB.exists(spark, path) else TB.read_table(spark, base, name, run)).select(*natural, key)
    return known


def write_keys(tables: dict[str, DataFrame], known: dict[str, DataFrame], base: str, run_id: str) -> None:
    """Keep the keys of this run and of all before it beside the run, for the loads to come."""
    for name, (natural, key) in DIMENSION_KEYS.items():
        own = tables[name].select(*natural, key)
        every = known[name].unionByName(own).distinct() if name in known else own
        every.write.mode("overwrite").parquet(TB.run_path(base, run_id, f"_keys/{name}"))


def build_3nf(staging: DataFrame, unique: str = "lookup_key", match: str = "title_date", unknown_member: bool = False,
              parallel: int = 4, known: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All eight target tables from staging, in dependency order; members in ``known`` have their keys from there.

    The independent dimensions are submitted from ``parallel`` driver threads, so their
    (small) jobs share the executors instead of queueing one after another.
    """
    known = known or {}

    def carried(name: str, dim: DataFrame) -> DataFrame:
        natural, key = DIMENSION_KEYS[name]
        return K.carry_keys(dim, known.get(name), natural, key)

    builders = {
        "companies": lambda: D.dim_companies(staging),
        "locations": lambda: D.dim_locations(staging, unique=unique),
        "platforms": lambda: D.dim_platforms(staging),
        "schedule_types": lambda: D.dim_schedule_types(staging),
        "skill_categories": lambda: D.dim_skill_categories(staging),
    }
    if parallel and parallel > 1:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            futures = {name: pool.submit(lambda n=name, fn=fn: carried(n, fn())) for name, fn in builders.items()}
            dims = {name: f.result() for name, f in futures.items()}
    else:
        dims = {name: carried(name, fn()) for name, fn in builders.items()}
    companies, categories = dims["companies"], dims["skill_categories"]
    skills = carried("skills", D.dim_skills(staging, categories))
    if unknown_member:
        companies = carried("companies", FX.with_unknown_company(companies))
    # The bridge needs the numbered postings only, so the lookups run once, where the fact is written.
    numbered = FX.postings(staging) if FX.one_member_per_key(dims["locations"]) else None
    jobs = FX.fact_jobs(staging, companies, dims["locations"], dims["platforms"], dims["schedule_types"],
                        unknown_member=unknown_member, keep_staging_id=True, numbered=numbered)
    bridge = B.bridge_job_skills(jobs if numbered is None else numbered, staging, skills, match=match)
    return {"companies": companies, "locations": dims["locations"], "platforms": dims["platforms"],
            "schedule_types": dims["schedule_types"], "skill_categories": categories, "skills": skills,
            "jobs": jobs, "job_skills": bridge}


ROW_RULES = [*NOT_NULL_RULES, *LENGTH_RULES, *CHECK_RULES]
ROW_RULE_NAMES = {NotNull: "not_null", MaxLength: "length", AllowedValues: "check"}


def _row_rules(table: str) -> dict[str, object]:
    return {f"{ROW_RULE_NAMES[type(r)]}:{table}.{r.column}": r for r in ROW_RULES if r.table == table}


def violation_counts(tables: dict[str, DataFrame], counts: dict[str, int] | None = None) -> dict[str, int]:
    """Violations of every rule of the schema: one pass per table for NOT NULL, lengths and allowed
    values (with the row count, put into ``counts``), a grouped count per UNIQUE or primary key, an
    anti join per foreign key. The checks are submitted together."""
    found: dict[str, int] = {}
    tasks = []
    for table, df in tables.items():
        tasks.append(lambda table=table, df=df: (table, C.row_violations(df, _row_rules(table))))
    for r in [*UNIQUE_RULES, *PRIMARY_KEY_RULES]:
        if r.table in tables:
            tasks.append(lambda r=r: (None, {f"unique:{r.table}({','.join(r.columns)})": C.check_unique(
                tables[r.table], r.columns, r.nulls_distinct).count()}))
    for r in FOREIGN_KEY_RULES:
        if r.table in tables and r.parent in tables:
            tasks.append(lambda r=r: (None, {f"foreign_key:{r.table}({','.join(r.columns)})": C.check_foreign_key(
                tables[r.table], tables[r.parent], r.columns, r.parent_columns).count()}))
    with ThreadPoolExecutor(max_workers=4) as pool:
        for table, got in pool.map(lambda t: t(), tasks):
            if table is not None:
                rows = got.pop("rows")
                if counts is not None:
                    counts[table] = rows
            found.update(got)
    return found


def quarantine(tables: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(kept, dropped) rows of each table: those that break a row rule go, parents first, and rows
    that refer to a dropped parent go with it."""
    out, dropped = dict(tables), {}
    for table in reversed(REFRESH_ORDER):
        if table not in out:
            continue
        bad = F.lit(False)
        for rule in _row_rules(table).values():
            bad = bad | C.broken(rule)
        rows = out[table].withColumn("_bad", bad)
        for r in FOREIGN_KEY_RULES:
            if r.table == table and r.parent in dropped:
                gone = dropped[r.parent].select(*[F.col(p).alias(c) for p, c in zip(r.parent_columns, r.columns)],
                                                F.lit(True).alias("_gone"))
                rows = rows.join(gone, list(r.columns), "left").withColumn(
                    "_bad", F.col("_bad") | F.coalesce("_gone", F.lit(False))).drop("_gone")
        columns = out[table].columns
        out[table] = rows.where(~F.col("_bad")).select(*columns)
        dropped[table] = rows.where("_bad").select(*columns)
    return out, dropped


def _transform_and_publish(spark: SparkSession, staging: DataFrame, base: str, run_id: str,
                           on_violation: str, rebuilt_staging: bool = False, stable_keys: bool = False,
                           **opts) -> LoadReport:
    """Build, (optionally quarantine), write once into the run folder, check, then publish.

    Intermediate tables of the build (surrogate-key tags) go under the run's ``_work``
    folder, which goes once the run is published. With ``stable_keys`` the members of earlier
    runs keep their surrogate keys (a chain of such runs never gives a key twice).
    """
    known = known_keys(spark, base) if stable_keys else {}
    with scratch_under(spark, f"{TB.run_path(base, run_id)}/_work"):
        tables = build_3nf(staging, known=known, **opts)
        viol = {}
        if on_violation == "quarantine":
            for name, df in tables.items():     # the keys of a build are written; fix the rows too before they are split
                path = f"{TB.run_path(base, run_id)}/_work/built/{name}"
                df.write.mode("overwrite").parquet(path)
                tables[name] = spark.read.parquet(path)
            tables, dropped = quarantine(tables)
            viol = {f"quarantined:{name}": n for name, n in ((k, d.count()) for k, d in dropped.items()) if n}
        run_ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        TB.write_tables(tables, base, run_id, run_ts)
        if stable_keys:
            write_keys({n: TB.read_table(spark, base, n, run_id) for n in DIMENSION_KEYS}, known, base, run_id)
    written = {name: TB.read_table(spark, base, name, run_id) for name in tables}
    counts: dict[str, int] = {}
    # Staging is held to its own limits, except where a quarantine has dropped what broke them.
    checked = written if on_violation == "quarantine" else {"staging": staging, **written}
    bad = {k: n for k, n in violation_counts(checked, counts).items() if n}
    counts.pop("staging", None)
    if bad:
        TB.remove(spark, f"{TB.run_path(base, run_id)}/_work")
        return LoadReport(False, run_id, "constraint violations: " + ", ".join(sorted(bad)), violations=bad)
    TB.publish(spark, base, run_id, rebuilt_staging)
    TB.remove(spark, f"{TB.run_path(base, run_id)}/_work")
    return LoadReport(True, run_id, None, counts, viol)


def run_full(spark: SparkSession, csv_path: str, base: str, on_violation: str = "fail",
             multiline: bool = False, date_format: str | list[str] | None = I.INFER, report: bool = True,
             most_lost: int | None = None, **opts) -> LoadReport:
    """L1. With ``report`` the quality metrics are written to the run folder before the gate decides.

    The date column's one format is inferred, unless ``date_format`` names formats or None (ISO
    only). A column of which coercion loses more than ``most_lost`` cells stops the load.
    """
    run_id = TB.new_run_id()
    run = TB.run_path(base, run_id)
    with scratch_under(spark, f"{run}/_work"):
        raw = read_postings_csv(spark, csv_path, None, multiline)
    quality = None
    if report:
        quality = f"{run}/_quality"
        quality_report(raw, quality)
    date_format = I.date_format_of(raw, date_format)
    lost = I.lost_cells(raw, date_format)
    ok, message = Q.gate(Q.find_failures(raw, Q.posting_rules()))
    heavy = sorted(c for c, n in lost.items() if most_lost is not None and n > most_lost)
    if ok and heavy:
        ok, message = False, f"more than {most_lost} cells lost in " + ", ".join(heavy)
    if not ok:
        TB.remove(spark, f"{run}/_work")
        return LoadReport(False, None, message, lost=lost, quality=quality)
    # A full run rebuilds staging from this file (ids from 1); readers see it when the run is published.
    TB.append_staging(I.stage(raw, date_format), base, batch=run_id, rebuild=True)
    out = _transform_and_publish(spark, TB.read_table(spark, base, "staging", run_id), base, run_id, on_violation,
                                 rebuilt_staging=True, **opts)
    out.lost, out.quality = lost, quality
    return out


def run_transform_only(spark: SparkSession, base: str, on_violation: str = "fail", **opts) -> LoadReport:
    run_id = TB.new_run_id()
    return _transform_and_publish(spark, TB.read_table(spark, base, "staging"), base, run_id, on_violation, **opts)


def run_ingest_only(spark: SparkSession, csv_path: str, base: str, multiline: bool = False,
                    date_format: str | list[str] | None = I.INFER) -> str:
    batch = TB.new_run_id()
    with scratch_under(spark, f"{base.rstrip('/')}/_work/{batch}"):
        raw = read_postings_csv(spark, csv_path, base, multiline)
    try:
        TB.append_staging(I.stage(raw, I.date_format_of(raw, date_format)), base, batch=batch)
    finally:
        TB.remove(spark, f"{base.rstrip('/')}/_work/{batch}")
    return batch


def run_star(spark: SparkSession, base: str, as_of: _dt.date) -> dict[str, int]:
    """Build the star schema from the published tables (H1-H10), write it and publish it; rows by table."""
    run_id = TB.new_run_id()
    root = f"{base.rstrip('/')}/star/{run_id}"
    t = {name: TB.read_table(spark, base, name) for name in REFRESH_ORDER}
    with scratch_under(spark, f"{root}/_work"):
        location, location_key = H.star_dim_location(t["locations"])
        titles = H.star_dim_job_title(t["jobs"])
        star = {
            "dim_company": H.star_dim_company(t["companies"]), "dim_location": location, "dim_date": H.star_dim_date(t["jobs"]),
            "dim_job_title": titles, "dim_platform": H.star_dim_platform(t["platforms"]),
            "dim_schedule_type": H.star_dim_schedule_type(t["schedule_types"]),
            "dim_skill": H.star_dim_skill(t["skills"], t["skill_categories"]),
            "dim_attributes": H.star_dim_attributes(spark), "bridge_job_skills": H.star_bridge_skills(t["job_skills"]),
            "fact_job_postings": H.star_fact_postings(t["jobs"], t["job_skills"], location_key, titles, as_of)}
        for name, df in star.items():
            df.write.parquet(f"{root}/{name}")
    TB.publish(spark, base, run_id, name="_star_current")
    TB.remove(spark, f"{root}/_work")
    return {name: TB.star_table(spark, base, name).count() for name in star}
