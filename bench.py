"""Pipeline benchmark: prints ONE JSON line.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and times:

* ``full_load``      – land the seven raw tables (fingerprint + stamp +
  key check) and publish every table of a first run (7 CDC tables +
  the order fact), reading the written raw tables back;
* ``cdc_{0,1,10}pct`` – a second day: fingerprint-guarded landing upsert of
  the new extract into the raw tables, the source's soft deletes, then the
  incremental run of every table, with about 0 %, 1 % and 10 % of keys
  new/changed/removed (the first load of each of these is set up untimed);
* ``contracts``      – all 207 declared tests over the published run;
* ``az_orders_rebuild`` – full rebuild and write of the order fact.

Everything is written as bucketed Parquet tables under a fresh scratch folder.
Before timing, every step runs once untimed on the sf0.001 tables to warm
up the JVM and code generation (the first minute of a fresh JVM is several
times slower than steady state).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from lakeward.operators.contracts import run_contracts  # noqa: E402
from lakeward.operators.table_store import TableStore  # noqa: E402
from lakeward.plans.contract_specs import SOURCE_ADDRESSES, SOURCE_CUSTOMERS, declared_tests  # noqa: E402
from lakeward.plans.models import MODELS, Run  # noqa: E402
from lakeward.plans.pipeline import RUN_TS, TwoDayPipeline  # noqa: E402
from lakeward.plans.runner import run_project, schema_of  # noqa: E402
from lakeward.plans.stored import StoredChain  # noqa: E402
from lakeward.session import get_spark  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.001"

# change rates (permille of keys) per role for the incremental runs
RATES = {
    "cdc_0pct": {"new": 0, "chg": 0, "gone": 0, "del": 0},
    "cdc_1pct": {"new": 3, "chg": 5, "gone": 1, "del": 1},
    "cdc_10pct": {"new": 30, "chg": 50, "gone": 10, "del": 10},
}


def contracts_on(chain: StoredChain) -> None:
    """All 207 declared tests over a published run (views rebuilt from its raw tables)."""
    run = Run(raw=chain.raw, run_ts=RUN_TS[2], previous=lambda n: None)
    tables = {name: chain.store.current(schema_of(name), name) if info.materialized != "view" else run.ref(name)
              for name, info in MODELS.items()}
    tables[SOURCE_CUSTOMERS] = chain.raw("customers")
    tables[SOURCE_ADDRESSES] = chain.raw("addresses")
    run_contracts(tables, declared_tests()).collect()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return round(time.perf_counter() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark("lakeward-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    scratch = tempfile.mkdtemp(prefix="lakeward-bench-", dir="/tmp")
    queries: dict[str, float] = {}

    def chain(name, data, rates=None) -> StoredChain:
        return StoredChain(TableStore(spark, f"{scratch}/{name}", cpus * 2, prefix=f"{name}_"), TwoDayPipeline(spark, data, rates=rates))

    # untimed JVM / code-generation warm-up: every timed step once on the smallest tables
    warm = chain("warmup", WARMUP_DIR)
    warm.first_day()
    warm.second_day()
    contracts_on(warm)

    # 1. first full load
    queries["full_load"] = timed(chain("full", sf_dir).first_day)

    # 2. incremental runs at three change rates
    last = None
    for label, rates in RATES.items():
        last = chain(label, sf_dir, rates)
        last.first_day()
        queries[label] = timed(last.second_day)

    # 3. contracts over the last published run (views rebuilt from its raw tables)
    queries["contracts"] = timed(lambda: contracts_on(last))

    # 4. order fact rebuild
    queries["az_orders_rebuild"] = timed(
        lambda: run_project(last.store, last.raw, RUN_TS[2], select=["az_orders"]))

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "pipeline_wall_seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
