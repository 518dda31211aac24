"""Print the executed (AQE-final) physical plans of the key builds.

Usage: python tools/show_plans.py [sf_dir] > docs/PLANS.md
Each frame is executed once (collect to a count) so the adaptive plan shows its final
shape: which joins were broadcast, where the exchanges are, what reached the scan.
The builds are shown before materialization (the mart keeps their results).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def builds(m):
    from postmart.operators import bridge as B
    from postmart.operators import dimensions as D
    from postmart.operators import facts as FX
    from postmart.operators import keys as K
    from postmart.operators import star as H
    from postmart.sources.ingest import arrival_ids, scan_csv, stage
    from pyspark.sql import functions as F

    def fact_lookups():
        s = FX.with_lookup_keys(FX.titled(m.staging))
        j = FX.lookup(s, m.companies, {"_company_key": "company_name"}, ["company_id"])
        j = FX.lookup(j, m.locations, {"_country_key": "country", "_location_key": "full_location"}, ["location_id"])
        j = FX.lookup(j, m.platforms, {"_platform_key": "platform_name"}, ["platform_id"])
        j = FX.lookup(j, m.schedules, {"_schedule_key": "schedule_type_name"}, ["schedule_type_id"])
        return j.select("id", "company_id", "location_id", "platform_id", "schedule_type_id")

    return {
        "staging (raw -> typed)": lambda: stage(m.raw),
        "arrival-order ids (P8) on the CSV": lambda: arrival_ids(scan_csv(m.spark, m.csv_path)),
        "fact lookups (J1-J4, before the dense key)": fact_lookups,
        "dense key (D9) on orders": lambda: K.dense_key(m.table("orders").select("o_orderkey", "o_orderdate"),
                                                        ["o_orderdate", "o_orderkey"], "order_seq"),
        "skill members (D7+D8, before the dense key)": lambda: D.skills_categorized(m.staging).unionByName(
            D.skills_uncategorized(m.staging)).groupBy("skill_name").agg(F.min("category_name")),
        "bridge (J9, title/date match)": lambda: B.bridge_job_skills(m.jobs, m.staging, m.skills),
        "pre-dedupe bridge count (A2)": lambda: B.count_bridge(m.jobs, m.staging, m.skills),
        "skills by category (H12)": lambda: H.skills_by_category(m.bridge, m.skills, m.categories),
        "star fact (H9)": lambda: H.star_fact_postings(m.jobs, m.bridge, m.star_location[1], m.star_titles,
                                                       "1999-01-01"),
    }


def main() -> None:
    from postmart.catalog import Mart
    from postmart.session import get_spark
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark(app="postmart-plans")
    m = Mart.get(spark, sf_dir)
    print(f"# Executed plans ({sf_dir.rsplit('/', 1)[-1]}, local[8], AQE on)\n")
    print("Generated by `tools/show_plans.py`. Each build ran once, so the adaptive plans are final.\n")
    for title, make in builds(m).items():
        df = make()
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("simple")
        text = buf.getvalue().strip().replace("\x00", "\\u0000")
        final = text.split("+- == Initial Plan ==")[0].rstrip()
        print(f"## {title}\n\n```\n{final}\n```\n")


if __name__ == "__main__":
    main()
