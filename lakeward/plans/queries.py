"""Registered queries: one per operator group, each over the whole driver tables.

Every query takes ``(spark, sf_dir)``, lands the stand-in operational data
for the two scenario days and returns one lazy DataFrame.  Timestamps are
``TIMESTAMP_NTZ`` (naive UTC, like the source's ``DATETIME2``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.frames import union_all

from lakeward.functions.hashing import surrogate_key
from lakeward.operators import cdc
from lakeward.operators.audit import batch_audit, load_summary
from lakeward.operators.contract_runs import run_contracts_once
from lakeward.operators import declared
from lakeward.operators.dedupe import dedupe_latest
from lakeward.operators.freshness import check_freshness
from lakeward.operators.landing import append_stamp, landing_reload, rows_affected
from lakeward.operators.lineage import value_leaks
from lakeward.operators.vault import cross_verify, lookup, lookup_by_clear_value
from lakeward.plans.append_jobs import APPEND_EXTRACTS, APPEND_TABLES
from lakeward.plans.contract_specs import (
    SOURCE_ADDRESSES,
    SOURCE_CUSTOMERS,
    declared_tests,
    documented_identities,
)
from lakeward.plans.models import CDC_MODELS, MODELS, Run
from lakeward.plans.pipeline import TwoDayPipeline, load_stamp
from lakeward.plans.runner import schema_of, select_models
from lakeward.plans.stored import StoredChain, scratch_store
from lakeward.session import shared_folder
from lakeward.sources.readers import DriverTables
from lakeward.sources.schemas import ENTITIES

Query = Callable[[SparkSession, str], DataFrame]

# Fixed probe values for the vault lookups and the run times of the
# re-run / freshness checks.
LOOKUP_CUSTOMER_ID = 42
LOOKUP_EMAIL = "furniture.42@Example.com"
LOOKUP_NATIONAL_ID = "000332598"
RERUN_TS = datetime(2024, 1, 3, 1, 0, 0)
FRESHNESS_AS_OF = datetime(2024, 1, 3, 12, 0, 0)
APPEND_LOAD_TS = datetime(2024, 1, 2, 6, 30, 0)
APPEND_ORDER_HEADER_COLS = [
    "sales_order_id", "revision_number", "order_date", "due_date", "ship_date", "status", "customer_id",
    "sales_person_id", "territory_id", "sub_total", "tax_amt", "freight", "total_due",
]


def _pipe(spark: SparkSession, sf_dir: str) -> TwoDayPipeline:
    return TwoDayPipeline(spark, sf_dir)


def _model_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _pipe(spark, sf_dir).run(2).ref(name)

    q.__doc__ = f"Model {name} after the day-2 incremental run."
    return q


def _landing_merge_query(entity: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _pipe(spark, sf_dir).merge_feed(entity)

    q.__doc__ = f"Day-2 fingerprint-guarded upsert of {entity} with its change type."
    return q


def _landing_reload_query(entity: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = _pipe(spark, sf_dir)
        return landing_reload(p.extract(entity, 2), ENTITIES[entity], load_stamp(entity, 2))

    q.__doc__ = f"Day-2 truncate-and-reload of {entity}."
    return q


def _staged_and_target(p: TwoDayPipeline, cert: str) -> tuple[DataFrame, DataFrame, tuple[str, ...]]:
    return p.run(2).staged_by_key(cert), p.run(1).ref(cert), ENTITIES[CDC_MODELS[cert][1]].key


def change_feed(cert: str) -> Query:
    def q(spark, sf_dir):
        staged, target, keys = _staged_and_target(_pipe(spark, sf_dir), cert)
        return cdc.classify_changes(staged, target, keys)

    q.__doc__ = f"Change feed (insert/update/unchanged/delete) of {cert}, day 2 vs day 1."
    return q


def detect_changes(cert: str) -> Query:
    def q(spark, sf_dir):
        staged, target, keys = _staged_and_target(_pipe(spark, sf_dir), cert)
        return cdc.detect_changes(staged, target, keys)

    q.__doc__ = f"Staged rows of {cert} that are new or changed on day 2."
    return q


def delete_orphans(cert: str) -> Query:
    def q(spark, sf_dir):
        staged, target, keys = _staged_and_target(_pipe(spark, sf_dir), cert)
        return cdc.delete_orphans(target, staged, keys)

    q.__doc__ = f"Day-1 rows of {cert} whose key survives in day-2 staging."
    return q


def cdc_change_counts(spark, sf_dir):
    """Rows per change type for all seven CDC tables (day 2 vs day 1)."""
    p = _pipe(spark, sf_dir)
    parts = []
    for cert in CDC_MODELS:
        staged, target, keys = _staged_and_target(p, cert)
        counts = cdc.change_counts(cdc.classify_changes(staged, target, keys))
        parts.append(counts.select(F.lit(cert).alias("model"), "*"))
    return union_all(parts)


def cdc_first_load_customers(spark, sf_dir):
    """First load (no target yet): every staged customer is inserted."""
    return _pipe(spark, sf_dir).run(1).ref("az_customers")


def cdc_idempotent_rerun_customers(spark, sf_dir):
    """A third run on day-2 data changes nothing: day-2 stamps survive."""
    p = _pipe(spark, sf_dir)
    project = CDC_MODELS["az_customers"][2]
    rerun = Run(raw=p.run(2).raw, run_ts=RERUN_TS)
    return cdc.apply_changes(p.run(2).ref("stg_crm__customers"), p.run(2).ref("az_customers"),
                             ENTITIES["customers"].key, project=project(rerun))


def cdc_stepwise_customers(spark, sf_dir):
    """Three-pass recipe (delete orphans, detect, merge) for az_customers day 2."""
    p = _pipe(spark, sf_dir)
    staged, target, keys = _staged_and_target(p, "az_customers")
    return cdc.apply_changes_stepwise(staged, target, keys, CDC_MODELS["az_customers"][2](p.run(2)))


def cdc_schema_sync_products(spark, sf_dir):
    """Incremental run onto a target lacking ``color`` and holding a dropped column."""
    p = _pipe(spark, sf_dir)
    staged, target, keys = _staged_and_target(p, "az_products")
    old = target.drop("color").withColumn("legacy_code", F.lit("x"))
    return cdc.apply_changes(staged, old, keys, CDC_MODELS["az_products"][2](p.run(2)))


def fn_surrogate_key_composite(spark, sf_dir):
    """Two-column surrogate key of every staged order line."""
    d = _pipe(spark, sf_dir).run(2).ref("stg_erp__order_details")
    return d.select("sales_order_id", "sales_order_detail_id",
                    surrogate_key(["sales_order_id", "sales_order_detail_id"]).alias("order_detail_sk"))


def dedupe_latest_events(spark, sf_dir):
    """Latest event per user over the whole events table (ties: highest event id)."""
    ev = DriverTables(spark, sf_dir)("events")
    return dedupe_latest(ev, ["user_id"], order_by=["ts"], tiebreak=["event_id"]).select(
        "user_id", "event_id", "ts", "event_type", "value")


def _tables_for(p: TwoDayPipeline, tests) -> dict[str, DataFrame]:
    """The day-2 tables the tests read (tested models and relationship parents)."""
    run = p.run(2)
    sources = {SOURCE_CUSTOMERS: "customers", SOURCE_ADDRESSES: "addresses"}
    names = {t.model for t in tests} | {t.to for t in tests if t.to}
    return {n: p.raw(sources[n], 2) if n in sources else run.ref(n) for n in names}


def _number_lines(p: TwoDayPipeline) -> None:
    """Write the numbered order lines, which a shuffle makes, for what reads them more than once."""
    p.write_source("sales_order_detail", f"{shared_folder(p.spark)}/lines-{uuid4().hex[:10]}")


def _contracts(p: TwoDayPipeline, tests) -> DataFrame:
    models = {n for t in tests for n in (t.model, t.to) if n in MODELS}
    readers = [n for n in models if "stg_erp__order_details" in select_models([f"+{n}"])]
    if len(readers) > 1:  # each is evaluated by a job of its own
        _number_lines(p)
    folder = f"{shared_folder(p.spark)}/contracts-{uuid4().hex[:10]}"
    return run_contracts_once(_tables_for(p, tests), tests, folder)


def contract_report(spark, sf_dir):
    """All 207 declared tests over the day-2 run, one row per test."""
    return _contracts(_pipe(spark, sf_dir), declared_tests())


def _contract_kind(kind: str) -> Query:
    def q(spark, sf_dir):
        return _contracts(_pipe(spark, sf_dir), [t for t in declared_tests() if t.test == kind])

    q.__doc__ = f"Every declared {kind} test over the day-2 run."
    return q


def contract_identities(spark, sf_dir):
    """Documented order-total identities checked as expression contracts."""
    return _contracts(_pipe(spark, sf_dir), documented_identities())


def landing_append_order_headers(spark, sf_dir):
    """Append-layout landing of order headers (load time/date, active flag)."""
    h = _pipe(spark, sf_dir).extract("order_headers", 2).select(*APPEND_ORDER_HEADER_COLS)
    return append_stamp(h, "ERP", APPEND_LOAD_TS)


def _append_history_query(entity: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        p, name = _pipe(spark, sf_dir), f"lakeward_{uuid4().hex[:10]}"
        folder = shared_folder(spark)
        spark.sql(f"CREATE DATABASE `{name}` LOCATION '{folder}/{name}'")
        if entity == "order_details":  # numbering the lines shuffles them: once, not at each of the three loads
            p.write_source("sales_order_detail", f"{folder}/{name}-source")
        # yesterday's account numbers are wider than the declared column, so customers are loaded as of today both times
        days = (2, 2) if entity == "customers" else (1, 2)
        for n, day in ((1, days[0]), (2, days[1]), (2, days[1])):  # the second load is repeated
            rows = APPEND_EXTRACTS[entity](p.ops(day))
            declared.load(rows, APPEND_TABLES[entity], name, f"load-{n}", APPEND_LOAD_TS.replace(day=n))
        return declared.history(spark, APPEND_TABLES[entity], name)

    q.__doc__ = f"Two loads of {entity}, the second one repeated, in the append layout's declared table."
    return q


def freshness_report(spark, sf_dir):
    """Freshness of the seven raw tables at a fixed check time."""
    p = _pipe(spark, sf_dir)
    return check_freshness({e: (p.raw(e, 2), s) for e, s in ENTITIES.items()}, FRESHNESS_AS_OF)


def vault_lookup_sk(spark, sf_dir):
    """Clear-text PII for one customer surrogate key."""
    vault = _pipe(spark, sf_dir).run(2).ref("int_pii_vault_customers")
    sk = hashlib.md5(str(LOOKUP_CUSTOMER_ID).encode()).hexdigest()  # the key as published
    return lookup(vault, "customer_sk", sk, ["customer_sk", "name", "email_address", "phone"])


def vault_lookup_id(spark, sf_dir):
    """Clear-text PII for one employee id."""
    vault = _pipe(spark, sf_dir).run(2).ref("int_pii_vault_employees")
    return lookup(vault, "business_entity_id", LOOKUP_CUSTOMER_ID,
                  ["business_entity_id", "national_id_number", "login_id", "birth_date"])


def vault_lookup_customer_id(spark, sf_dir):
    """Clear-text PII for one customer id."""
    vault = _pipe(spark, sf_dir).run(2).ref("int_pii_vault_customers")
    return lookup(vault, "customer_id", LOOKUP_CUSTOMER_ID, ["customer_id", "name", "email_address", "phone"])


def vault_lookup_employee_sk(spark, sf_dir):
    """Clear-text PII for one employee surrogate key."""
    vault = _pipe(spark, sf_dir).run(2).ref("int_pii_vault_employees")
    sk = hashlib.md5(str(LOOKUP_CUSTOMER_ID).encode()).hexdigest()  # the key as published
    return lookup(vault, "employee_sk", sk, ["employee_sk", "national_id_number", "login_id", "birth_date"])


def vault_lookup_employee_hash(spark, sf_dir):
    """Keys of the employees whose national id hashes like a given clear value."""
    vault = _pipe(spark, sf_dir).run(2).ref("int_pii_vault_employees")
    return lookup_by_clear_value(vault, "national_id_hash", LOOKUP_NATIONAL_ID, ["employee_sk", "business_entity_id"])


def landing_rows_affected(spark, sf_dir):
    """Rows each day-2 landing upsert inserted or updated, per raw table."""
    p = _pipe(spark, sf_dir)
    return union_all([
        rows_affected(p.merge_feed(e)).select(F.lit(f"{s.raw_schema_name}.{e}").alias("table"), "rows_affected")
        for e, s in ENTITIES.items()
    ])


def vault_lookup_hash(spark, sf_dir):
    """Keys of the customers whose e-mail hashes like a given clear value."""
    vault = _pipe(spark, sf_dir).run(2).ref("int_pii_vault_customers")
    return lookup_by_clear_value(vault, "email_address_hash", LOOKUP_EMAIL, ["customer_sk", "customer_id"])


def vault_cross_verify(spark, sf_dir):
    """Vault hashes vs published hashes, per column, customers and employees."""
    run = _pipe(spark, sf_dir).run(2)
    c = cross_verify(run.ref("int_pii_vault_customers"), run.ref("az_customers"), "customer_sk",
                     ["full_name_hash", "email_address_hash", "phone_hash"])
    e = cross_verify(run.ref("int_pii_vault_employees"), run.ref("az_employees"), "employee_sk",
                     ["national_id_hash", "login_id_hash", "birth_date_hash"])
    return (c.select(F.lit("customers").alias("vault"), "*")
            .unionByName(e.select(F.lit("employees").alias("vault"), "*")))


def audit_load_summary(spark, sf_dir):
    """Row count of every raw table after the day-2 load."""
    p = _pipe(spark, sf_dir)
    return load_summary({f"{s.raw_schema_name}.{e}": p.raw(e, 2) for e, s in ENTITIES.items()})


def audit_batches(spark, sf_dir):
    """Rows, first load time and batches per source entity (day-2 raw)."""
    p = _pipe(spark, sf_dir)
    return batch_audit({e: p.raw(e, 2) for e in ENTITIES})


def star_join(spark, sf_dir):
    """Published star: order lines -> headers -> products, customers by key.

    Customers join the headers and products the lines before these two meet, so
    that no shuffle of all lines carries what the customers and headers add.
    """
    p = _pipe(spark, sf_dir)
    _number_lines(p)
    run = p.run(2)
    d, h = run.ref("az_order_details"), run.ref("az_order_headers")
    pr, c = run.ref("az_products"), run.ref("az_customers")
    lines = d.select("sales_order_id", "sales_order_detail_id", "product_id", "line_total")
    heads = h.select("sales_order_id", "customer_sk", "order_date")
    prods = pr.select("product_id", "product_name")
    custs = c.select("customer_sk", "account_number")
    return (lines.join(prods, "product_id", "left")
            .join(heads.join(custs, "customer_sk", "left"), "sales_order_id", "inner")
            .select("sales_order_id", "sales_order_detail_id", "order_date", "customer_sk",
                    "account_number", "product_id", "product_name", "line_total"))


def star_addresses(spark, sf_dir):
    """Published star: addresses with the account of the customer they belong to."""
    run = _pipe(spark, sf_dir).run(2)
    addresses = run.ref("az_addresses").select("address_id", "customer_sk", "city", "country_region")
    accounts = run.ref("az_customers").select("customer_sk", "account_number")
    return addresses.join(accounts, "customer_sk", "left")


def star_orders(spark, sf_dir):
    """Published star: the order fact with its customer's account and its product's name."""
    run = _pipe(spark, sf_dir).run(2)
    fact = run.ref("az_orders").select("sales_order_id", "sales_order_detail_id", "customer_sk", "product_id", "line_total_net")
    accounts = run.ref("az_customers").select("customer_sk", "account_number")
    products = run.ref("az_products").select("product_id", "product_name")
    return fact.join(accounts, "customer_sk", "left").join(products, "product_id", "left")


def cdc_typed_feed_customers(spark, sf_dir):
    """New state of the certified customers with each row's change type, and the rows that go, as ``delete``."""
    run = _pipe(spark, sf_dir).run(2)
    staging, entity, project = CDC_MODELS["az_customers"]
    return cdc.apply_changes(run.ref(staging), run.previous("az_customers"), ENTITIES[entity].key, project=project(run),
                             validate_keys=run.validate_keys, with_change_type=True)


def _stored_chain(spark: SparkSession, sf_dir: str) -> StoredChain:
    return StoredChain(scratch_store(spark), TwoDayPipeline(spark, sf_dir), unprinted=True)


def _chain_query(cert: str) -> Query:
    entity = CDC_MODELS[cert][1]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        chain = _stored_chain(spark, sf_dir)
        chain.first_day([entity], [cert])
        chain.second_day([entity], [cert])
        chain.drop(entity)
        return chain.store.current(schema_of(cert), cert)

    q.__doc__ = f"{cert} on written tables: landed in full, upserted, flagged, staged and published by changed buckets."
    return q


def chain_raw_order_details(spark, sf_dir):
    """The landed order lines after a full load, an upsert by changed buckets and the source's soft deletes."""
    chain = _stored_chain(spark, sf_dir)
    chain.land_full("order_details")
    chain.land_changes("order_details")
    return chain.raw("order_details")


def chain_change_counts(spark, sf_dir):
    """Rows by change type that the writing jobs of the second day counted, for each certified table."""
    chain, counts = _stored_chain(spark, sf_dir), {}
    for cert, (_, entity, _) in CDC_MODELS.items():
        # no certified table reads another entity: one at a time, so that not all tables lie on disk at once
        chain.first_day([entity], [cert])
        counts |= chain.second_day([entity], [cert])
        chain.drop(entity, cert)
    rows = [(m, t, counts[m].get(t, 0)) for m in CDC_MODELS for t in ("insert", "update", "delete")]
    return spark.createDataFrame(rows, "model string, _change_type string, rows long")


def chain_second_run(spark, sf_dir):
    """Buckets that a further run over the same landed customers and order lines finds changed, of all that they have."""
    chain = _stored_chain(spark, sf_dir)
    certs = ["az_customers", "az_order_details"]
    entities = [CDC_MODELS[c][1] for c in certs]
    chain.first_day(entities, certs)
    chain.second_day(entities, certs)
    rows = []
    for cert, entity in zip(certs, entities):
        staged = Run(raw=chain.raw, run_ts=RERUN_TS).ref(CDC_MODELS[cert][0])
        landed, _ = chain.store.touched(ENTITIES[entity].raw_schema_name, entity, chain.extract(entity, 2), ENTITIES[entity].key)
        published, digests = chain.store.touched(schema_of(cert), cert, staged, ENTITIES[entity].key)
        rows.append((cert, len(landed), len(published), sum(n for n, _, _ in digests.values())))
    return spark.createDataFrame(rows, "model string, landed_buckets long, published_buckets long, rows long")


def leak_scan(spark, sf_dir):
    """Different values of the published text columns that are clear values of the vaults or of staged addresses: none may be."""
    run = _pipe(spark, sf_dir).run(2)
    customers, employees = run.ref("int_pii_vault_customers"), run.ref("int_pii_vault_employees")
    addresses = run.ref("stg_crm__addresses")
    parts = [
        value_leaks({m: run.ref(m) for m in ("az_customers", "az_orders")}, ["name", "email_address", "phone"], customers),
        value_leaks({"az_employees": run.ref("az_employees")}, ["national_id_number", "login_id"], employees),
        value_leaks({"az_addresses": run.ref("az_addresses")}, ["address_line1", "address_line2"], addresses)]
    return union_all(parts)


def build_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in MODELS:
        q[name] = _model_query(name)
    for entity in ENTITIES:
        q[f"landing_merge_{entity}"] = _landing_merge_query(entity)
        q[f"landing_reload_{entity}"] = _landing_reload_query(entity)
    for cert in ("az_customers", "az_order_details"):
        short = cert.removeprefix("az_")
        q[f"cdc_change_feed_{short}"] = change_feed(cert)
        q[f"cdc_detect_changes_{short}"] = detect_changes(cert)
        q[f"cdc_delete_orphans_{short}"] = delete_orphans(cert)
    q["cdc_change_counts"] = cdc_change_counts
    q["cdc_first_load_customers"] = cdc_first_load_customers
    q["cdc_idempotent_rerun_customers"] = cdc_idempotent_rerun_customers
    q["cdc_stepwise_customers"] = cdc_stepwise_customers
    q["cdc_schema_sync_products"] = cdc_schema_sync_products
    q["fn_surrogate_key_composite"] = fn_surrogate_key_composite
    q["dedupe_latest_events"] = dedupe_latest_events
    q["contract_report"] = contract_report
    for kind in ("not_null", "unique", "accepted_values", "relationships", "unique_combination_of_columns"):
        q[f"contract_{kind}"] = _contract_kind(kind)
    q["contract_identities"] = contract_identities
    q["landing_append_order_headers"] = landing_append_order_headers
    for entity in APPEND_TABLES:
        q[f"append_history_{entity}"] = _append_history_query(entity)
    q["freshness_report"] = freshness_report
    q["vault_lookup_sk"] = vault_lookup_sk
    q["vault_lookup_id"] = vault_lookup_id
    q["vault_lookup_hash"] = vault_lookup_hash
    q["vault_lookup_customer_id"] = vault_lookup_customer_id
    q["vault_lookup_employee_sk"] = vault_lookup_employee_sk
    q["vault_lookup_employee_hash"] = vault_lookup_employee_hash
    q["landing_rows_affected"] = landing_rows_affected
    q["vault_cross_verify"] = vault_cross_verify
    q["audit_load_summary"] = audit_load_summary
    q["audit_batches"] = audit_batches
    q["star_join"] = star_join
    q["star_addresses"] = star_addresses
    q["star_orders"] = star_orders
    q["cdc_typed_feed_customers"] = cdc_typed_feed_customers
    for cert in CDC_MODELS:
        q[f"chain_{cert}"] = _chain_query(cert)
    q["chain_raw_order_details"] = chain_raw_order_details
    q["chain_change_counts"] = chain_change_counts
    q["chain_second_run"] = chain_second_run
    q["leak_scan"] = leak_scan
    return q

