"""Print the at-scale physical plan skeleton of the key operators.

AQE and automatic broadcasts are switched off, so the plans are the ones
large inputs get (sort-merge joins, hash exchanges).  Raw tables are first
landed to Parquet so scans show their pushed filters and read schemas.

    python tools/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from lakeward.operators.contracts import run_contracts  # noqa: E402
from lakeward.operators.landing import landing_reload  # noqa: E402
from lakeward.operators.table_store import TableStore  # noqa: E402
from lakeward.plans.contract_specs import declared_tests  # noqa: E402
from lakeward.plans.models import Run  # noqa: E402
from lakeward.plans.pipeline import RUN_TS, TwoDayPipeline, load_stamp  # noqa: E402
from lakeward.plans.runner import run_project, schema_of  # noqa: E402
from lakeward.session import get_spark  # noqa: E402
from lakeward.sources.schemas import ENTITIES  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|Scan|WindowGroupLimit|Window |HashAggregate|SortAggregate|Union|"
                  r"BroadcastExchange|ReusedExchange|Expand|Filter)")


def skeleton(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", line)
            lines.append(line[:220])
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_spark("lakeward-plans", master="local[4]")
    store = TableStore(spark, tempfile.mkdtemp(prefix="lakeward-plans-", dir="/tmp"), 64)
    p = TwoDayPipeline(spark, sf_dir)
    for e, spec in ENTITIES.items():
        store.replace(spec.raw_schema_name, e, landing_reload(p.extract(e, 1), spec, load_stamp(e, 1)), spec.key)
    raw = lambda e: store.current(ENTITIES[e].raw_schema_name, e)
    run_project(store, raw, RUN_TS[1])
    for e, spec in ENTITIES.items():
        store.replace(spec.raw_schema_name, e, p.raw(e, 2), spec.key)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    run = Run(raw=raw, run_ts=RUN_TS[2], previous=lambda name: store.current(schema_of(name), name))
    shown = {
        "az_order_details (incremental CDC apply, composite key)": run.ref("az_order_details"),
        "int_customers (two latest-row dedupes + left join)": run.ref("int_customers"),
        "int_orders (headers x customer keys, then x lines)": run.ref("int_orders"),
        "stg_crm__customers (soft-delete filter pushed to Parquet)": run.ref("stg_crm__customers"),
        "contracts of az_customers (one scan aggregate + one grouping-sets pass for its unique tests)": run_contracts(
            {"az_customers": store.current("azure_fabric", "az_customers")},
            [t for t in declared_tests() if t.model == "az_customers"]),
    }
    print("# Physical plans at scale\n")
    print("Generated by `python tools/show_plans.py` with AQE and automatic broadcasts off "
          "(the plans large inputs get). Only exchanges, joins, scans, windows and aggregates are shown.\n")
    for title, df in shown.items():
        print(f"## {title}\n\n```\n{skeleton(df)}\n```\n")


if __name__ == "__main__":
    main()
