
import datetime as dt

from pyspark.sql import functions as F

from postmart.operators import bridge as B
from postmart.operators import dimensions as D
from postmart.operators import facts as FX
from postmart.schemas import STAGING_SCHEMA


def staging(spark, rows):
    full = []
    names = [f.name for f in STAGING_SCHEMA.fields]
    for i, r in enumerate(rows):
        d = {n: None for n in names}
        d.update(r)
        d["id"] = d["id"] if d["id"] is not None else i + 1
        full.append(tuple(d[n] for n in names))
    return spark.createDataFrame(full, STAGING_SCHEMA)


def build(stg, **kw):
    comp, loc = D.dim_companies(stg), D.dim_locations(stg, **kw)
    plat, sch = D.dim_platforms(stg), D.dim_schedule_types(stg)
    return comp, loc, plat, sch, FX.fact_jobs(stg, comp, loc, plat, sch, keep_staging_id=True)


def test_t1_null_company_has_no_member(spark):
    stg = staging(spark, [{"job_title": "a", "company_name": None}, {"job_title": "b", "company_name": "  "},
                          {"job_title": "c", "company_name": " X "}])
    comp, *_, jobs = build(stg)
    assert [r["company_name"] for r in comp.collect()] == ["X"]
    assert sorted((r["job_title"], r["company_id"]) for r in jobs.collect()) == [("a", None), ("b", None), ("c", 1)]
    comp2 = FX.with_unknown_company(comp)
    jobs2 = FX.fact_jobs(stg, comp, *build(stg)[1:4], unknown_member=True)
    assert {r["company_name"] for r in comp2.collect()} == {"X", "Unknown"}
    assert {r["job_title"]: r["company_id"] for r in jobs2.collect()}["a"] == 2


def test_t3_null_distinct_locations_double_postings(spark):
    stg = staging(spark, [{"job_title": "a", "job_location": None, "job_country": None},
                          {"job_title": "b", "job_location": None, "job_country": "Unknown"}])
    *_, jobs = build(stg)
    assert jobs.count() == 2
    *_, jobs_ref = build(stg, unique="nulls_distinct")
    assert jobs_ref.count() == 4  # each posting matches both 'Unknown'/'Unknown' members


def test_t4_title_date_bridge_borrows_and_loses(spark):
    day = dt.datetime(2024, 1, 1)
    stg = staging(spark, [
        {"job_title": "eng", "job_posted_date": day, "job_skills": ["python"]},
        {"job_title": "eng", "job_posted_date": day, "job_skills": ["sql"]},
        {"job_title": "ops", "job_posted_date": None, "job_skills": ["bash"]},
    ])
    *_, jobs = build(stg)
    skills = D.dim_skills(stg, D.dim_skill_categories(stg))
    pairs = B.bridge_job_skills(jobs, stg, skills).count()
    by_id = B.bridge_job_skills(jobs, stg, skills, match="id").count()
    assert pairs == 4   # both 'eng' postings get both skills; NULL date links nothing
    assert by_id == 3


def test_t5_t8_categories(spark):
    stg = staging(spark, [{"job_title": "a", "job_type_skills": '{"b":["Python"],"a":["python "],"c":"text"}'}])
    cats = D.dim_skill_categories(stg)
    assert sorted(r["category_name"] for r in cats.collect()) == ["a", "b", "c"]
    skills = D.dim_skills(stg, cats).join(cats, "category_id").collect()
    assert [(r["skill_name"], r["category_name"]) for r in skills] == [("python", "a")]


def test_t6_t7_strip_vs_trim_and_null_items(spark):
    stg = staging(spark, [{"job_title": "a", "job_posted_date": dt.datetime(2024, 1, 1),
                           "job_skills": ["\tpython", None, "", "Go "]}])
    skills = D.dim_skills(stg, D.dim_skill_categories(stg))
    assert sorted(r["skill_name"] for r in skills.collect()) == ["", "go", "python"]
    *_, jobs = build(stg)
    names = dict((r["skill_id"], r["skill_name"]) for r in skills.collect())
    linked = sorted(names[r["skill_id"]] for r in B.bridge_job_skills(jobs, stg, skills).collect())
    assert linked == ["", "go"]  # '\tpython' never matches: TRIM removes spaces only


def test_t10_missing_columns_are_required(spark):
    from postmart.operators import quality as Q
    df = spark.createDataFrame([(1, "x")], "id long, job_title string")
    ok, msg = Q.gate(Q.find_failures(df, Q.posting_rules()))
    assert not ok and "job_skills" in msg


def test_count_bridge_is_linear_form_of_join(spark):
    day = dt.datetime(2024, 1, 1)
    stg = staging(spark, [{"job_title": "eng", "job_posted_date": day, "job_skills": ["a", "b"]}] * 3)
    *_, jobs = build(stg)
    skills = D.dim_skills(stg, D.dim_skill_categories(stg))
    assert B.count_bridge(jobs, stg, skills).first()[0] == 3 * 6  # 3 jobs x 6 matched items
    assert B.bridge_job_skills(jobs, stg, skills).count() == 6
