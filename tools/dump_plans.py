"""Write the physical plans of the build steps and of every registered query
of the sales pipeline to PLANS.md.

    python tools/dump_plans.py [sf_dir]

Build steps and queries are run, so their plans are the final ones of AQE.
The marts and the fact build follow once more with broadcasts off, as for
dimensions beyond the broadcast bound; those plans are the ones before AQE.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df, run: bool = True) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan()
    if run:
        plan.executeCollect()  # run this very plan in the JVM so AQE finalises it
    lines = []
    for line in plan.toString().splitlines():
        line = re.sub(r"\[plan_id=\d+\]", "", re.sub(r"#\d+L?", "", line))
        lines.append(line if len(line) <= 160 else line[:157] + "...")
    return ["```", *lines, "```", ""]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from ledgerline.operators.features import store_day_features
    from ledgerline.operators.star import build_dim_date, build_fact_sales, unique_on
    from ledgerline.operators.validate import first_copies
    from ledgerline.plans import catalog, marts
    from ledgerline.session import local_session

    spark = local_session(8, 16)
    pipe = catalog.build(spark, sf_dir)
    star = pipe.star
    out = ["# Physical plans", "", f"At `{sf_dir}`, generated by `tools/dump_plans.py`.", "", "# Build steps", ""]
    steps = {
        "feed and keep-first (written once)": first_copies(pipe.raw),
        "dim_date": build_dim_date(pipe.staging),
        "dim_product, distinct natural keys (then numbered)": pipe.staging.select("sku", "category").distinct(),
        "fact_sales (written once)": build_fact_sales(pipe.staging, star.dim_store, star.dim_product),
        "check of repeated transaction ids": star.fact_sales.groupBy("transaction_id").count().agg({"count": "max"}),
        "store-day features (written once)": store_day_features(star),
    }
    assert unique_on(star.dim_date.df, "date_key")
    for name, df in steps.items():
        out += [f"## {name}", "", *tree(df)]
    out += ["# Queries", ""]
    for name, fn in catalog.QUERIES.items():
        out += [f"## {name}", "", *tree(fn(spark, sf_dir))]
    out += ["# With broadcasts off", ""]
    spark.conf.set("ledgerline.maxBroadcastRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    beyond = {
        "fact_sales": lambda: build_fact_sales(pipe.staging, star.dim_store, star.dim_product),
        "revenue_decomposition": lambda: marts.revenue_decomposition(star, 1999, 2000),
        "store_pl": lambda: marts.store_pl(star, 1999, 2000),
        "discount_leakage": lambda: marts.discount_leakage(star),
        "seasonality": lambda: marts.seasonality(star),
        "store_day_features": lambda: store_day_features(star),
    }
    for name, fn in beyond.items():
        out += [f"## {name}", "", *tree(fn(), run=False)]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
