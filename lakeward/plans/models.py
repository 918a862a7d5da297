"""The twenty models of the governed pipeline as DataFrame functions.

Layers:

* **staging** (7 views) – live rows of each raw table, typed;
* **intermediate** (5 views) – deduplicated and enriched customers and
  employees, the order fact with net/discount maths, and two restricted
  clear-text PII vaults;
* **certified** (8 tables) – seven change-data-capture tables published by
  :func:`~lakeward.operators.cdc.apply_changes` and one fully rebuilt order
  fact.

A :class:`Run` supplies the raw tables, the run's load time and (for
incremental runs) the previous state of every certified table.  Each
model is built once per run and reused by its dependants, so one run is
one set of lazy plans that Catalyst optimises end to end.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.decimals import discount_amount, line_total_net
from lakeward.functions.hashing import pii_hash, surrogate_key
from lakeward.functions.text import clean_lower, clean_upper, date_text
from lakeward.operators.cdc import apply_changes
from lakeward.operators.dedupe import dedupe_latest
from lakeward.operators.joins import left_join_spread
from lakeward.operators.lineage import hashed
from lakeward.operators.staging import loaded_at, stage
from lakeward.sources.schemas import (
    BATCH_ID,
    ENTITIES,
    INGESTED_AT,
    PIPELINE_NAME,
    RAW_HASH,
    SOURCE_ENTITY,
    SOURCE_SYSTEM,
)

CDC_LINEAGE = [INGESTED_AT, SOURCE_SYSTEM, SOURCE_ENTITY, PIPELINE_NAME, BATCH_ID, RAW_HASH]


@dataclass(frozen=True)
class ModelInfo:
    name: str
    layer: str                      # staging | intermediate | certified
    materialized: str               # view | incremental | table
    depends_on: tuple[str, ...]
    tags: tuple[str, ...] = ()
    unique_key: tuple[str, ...] = ()
    pii_fields: tuple[str, ...] = ()   # clear-text personal columns it holds
    pii_free: bool = True
    build: Callable | None = None
    access: str | None = None          # internal | restricted
    contract_status: str | None = None
    pii_vault: str | bool | None = None  # vault holding its clear values, or True for a vault
    never_export: bool = False
    small: bool = False                # a reference table that one task reads


MODELS: dict[str, ModelInfo] = {}


def model(name: str, layer: str, materialized: str, depends_on=(), tags=(), unique_key=(),
          pii_fields=(), pii_free=True):
    layer_tags = {"staging": ("staging", "stg"), "intermediate": ("intermediate", "int"),
                  "certified": ("azure", "az")}[layer]

    def register(fn):
        MODELS[name] = ModelInfo(name, layer, materialized, tuple(depends_on),
                                 layer_tags + tuple(tags), tuple(unique_key), tuple(pii_fields),
                                 pii_free, fn)
        return fn

    return register


@dataclass
class Run:
    """Inputs of one pipeline run."""

    raw: Callable[[str], DataFrame]                      # entity name -> raw table
    run_ts: datetime                                      # the run's load stamp
    previous: Callable[[str], DataFrame | None] = lambda name: None
    validate_keys: bool = True
    raw_by_key: Callable[[str], DataFrame] | None = None  # the same dealt by whole keys, if that is not how they come
    _built: dict[str, DataFrame] = field(default_factory=dict)

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = MODELS[name].build(self)
        return self._built[name]

    def staged_by_key(self, cert: str) -> DataFrame:
        """Staged rows of a certified table, for joins on its whole key."""
        staging, entity, _ = CDC_MODELS[cert]
        if self.raw_by_key is None or len(ENTITIES[entity].key) == 1:
            return self.ref(staging)
        return stage(self.raw_by_key(entity), ENTITIES[entity], self.run_ts)

    def pin(self, name: str, df: DataFrame) -> None:
        """Make dependants of ``name`` read ``df`` (e.g. its written copy)."""
        self._built[name] = df


# ---------------------------------------------------------------------------
# staging
# ---------------------------------------------------------------------------

def _staging(model_name: str, entity: str):
    pii = ENTITIES[entity].pii

    @model(model_name, "staging", "view", pii_fields=pii, pii_free=not pii,
           unique_key=ENTITIES[entity].key)
    def build(run: Run) -> DataFrame:
        return stage(run.raw(entity), ENTITIES[entity], run.run_ts)

    return build


stg_crm__customers = _staging("stg_crm__customers", "customers")
stg_crm__addresses = _staging("stg_crm__addresses", "addresses")
stg_erp__order_headers = _staging("stg_erp__order_headers", "order_headers")
stg_erp__order_details = _staging("stg_erp__order_details", "order_details")
stg_erp__products = _staging("stg_erp__products", "products")
stg_hr__employees = _staging("stg_hr__employees", "employees")
stg_hr__departments = _staging("stg_hr__departments", "departments")


# ---------------------------------------------------------------------------
# intermediate
# ---------------------------------------------------------------------------

ADDRESS_COLS = ["address_line1", "address_line2", "city", "state_province_id", "postal_code",
                "country_region"]


@model("int_customers", "intermediate", "view",
       depends_on=("stg_crm__customers", "stg_crm__addresses"), unique_key=("customer_id",),
       pii_fields=("full_name", "email_address", "phone"), pii_free=False)
def int_customers(run: Run) -> DataFrame:
    """Customers with their latest address, deduplicated, keyed and hashed.

    Hashes are over the *normalised* name and e-mail (trimmed, upper/lower
    case), unlike the vault and certified tables which hash raw values.
    """
    addresses = dedupe_latest(
        run.ref("stg_crm__addresses").select("customer_id", "address_id", *ADDRESS_COLS, INGESTED_AT),
        keys=["customer_id"], order_by=[INGESTED_AT], tiebreak=["address_id"],
    ).drop("address_id", INGESTED_AT)
    c = run.ref("stg_crm__customers")
    enriched = c.join(addresses, "customer_id", "left").select(
        "customer_id", "person_id", "store_id", "territory_id", "account_number",
        clean_upper("name").alias("full_name"),
        clean_lower("email_address").alias("email_address"),
        "phone", *ADDRESS_COLS, INGESTED_AT, SOURCE_SYSTEM, PIPELINE_NAME, BATCH_ID, RAW_HASH,
    )
    latest = dedupe_latest(enriched, keys=["customer_id"], order_by=[INGESTED_AT],
                           tiebreak=[RAW_HASH, BATCH_ID])
    return latest.select(
        surrogate_key(["customer_id"]).alias("customer_sk"),
        "customer_id", "person_id", "store_id", "territory_id", "account_number",
        "full_name", "email_address", "phone",
        hashed(pii_hash("full_name"), "full_name_hash", "full_name"),
        hashed(pii_hash("email_address"), "email_address_hash", "email_address"),
        hashed(pii_hash("phone"), "phone_hash", "phone"),
        *ADDRESS_COLS, INGESTED_AT, SOURCE_SYSTEM, PIPELINE_NAME, BATCH_ID,
        loaded_at(run.run_ts),
    )


EMPLOYEE_WORK = ["job_title", "marital_status", "gender", "hire_date", "salaried_flag",
                 "vacation_hours", "sick_leave_hours"]


def _employee_hashes():
    return [
        hashed(pii_hash("national_id_number"), "national_id_hash", "national_id_number"),
        hashed(pii_hash("login_id"), "login_id_hash", "login_id"),
        hashed(pii_hash(date_text("birth_date")), "birth_date_hash", "birth_date"),
    ]


@model("int_employees", "intermediate", "view", depends_on=("stg_hr__employees",),
       unique_key=("business_entity_id",),
       pii_fields=("national_id_number", "login_id", "birth_date"), pii_free=False)
def int_employees(run: Run) -> DataFrame:
    latest = dedupe_latest(run.ref("stg_hr__employees"), keys=["business_entity_id"],
                           order_by=[INGESTED_AT], tiebreak=[RAW_HASH, BATCH_ID])
    return latest.select(
        surrogate_key(["business_entity_id"]).alias("employee_sk"),
        "business_entity_id", "national_id_number", "login_id", "birth_date",
        *_employee_hashes(), *EMPLOYEE_WORK,
        INGESTED_AT, SOURCE_SYSTEM, PIPELINE_NAME, BATCH_ID, loaded_at(run.run_ts),
    )


@model("int_orders", "intermediate", "view",
       depends_on=("stg_erp__order_headers", "stg_erp__order_details", "int_customers"))
def int_orders(run: Run) -> DataFrame:
    """Order lines joined to their header and to the customer key.

    ``customer_sk`` is NULL when the header's customer is not a known
    customer.  Only the existence of the customer matters (the key is a
    pure function of ``customer_id``), so the join uses the distinct
    customer ids of the staged customers — exactly the ids of
    ``int_customers`` — and the header side is joined to it *before* the
    lines, so the large line table is shuffled once (on the order id).  A
    customer with a large share of all orders is spread over several tasks.
    """
    h = run.ref("stg_erp__order_headers")
    d = run.ref("stg_erp__order_details")
    known = (run.ref("stg_crm__customers").select("customer_id").where(F.col("customer_id").isNotNull())
             .distinct().select(F.col("customer_id").alias("known_customer_id")))
    h = left_join_spread(h, known, "customer_id", "known_customer_id", spread_by="sales_order_id")
    joined = h.alias("h").join(d.alias("d"), F.col("h.sales_order_id") == F.col("d.sales_order_id"), "inner")
    return joined.select(
        F.col("h.sales_order_id").alias("sales_order_id"),
        F.col("d.sales_order_detail_id").alias("sales_order_detail_id"),
        F.when(F.col("known_customer_id").isNotNull(), surrogate_key([F.col("h.customer_id")])).alias("customer_sk"),
        F.col("h.customer_id").alias("customer_id"),
        "h.order_date", "h.due_date", "h.ship_date", "h.status", "h.online_order_flag",
        "h.sales_order_number",
        "d.product_id", "d.order_qty", "d.unit_price", "d.unit_price_discount", "d.line_total",
        line_total_net("d.order_qty", "d.unit_price", "d.unit_price_discount").alias("line_total_net"),
        discount_amount("d.order_qty", "d.unit_price", "d.unit_price_discount").alias("discount_amount"),
        "h.sub_total", "h.total_due",
        F.col("h." + INGESTED_AT).alias(INGESTED_AT),
        F.col("h." + SOURCE_SYSTEM).alias(SOURCE_SYSTEM),
        F.col("h." + PIPELINE_NAME).alias(PIPELINE_NAME),
        F.col("h." + BATCH_ID).alias(BATCH_ID),
        loaded_at(run.run_ts),
    )


@model("int_pii_vault_customers", "intermediate", "view", depends_on=("stg_crm__customers",),
       tags=("pii_vault", "restricted", "local_only"), unique_key=("customer_id",),
       pii_fields=("name", "email_address", "phone"), pii_free=False)
def int_pii_vault_customers(run: Run) -> DataFrame:
    """Restricted: clear-text customer PII beside its keys and raw-value hashes."""
    return run.ref("stg_crm__customers").select(
        surrogate_key(["customer_id"]).alias("customer_sk"),
        "customer_id", "account_number", "name", "email_address", "phone",
        hashed(pii_hash("name"), "full_name_hash", "name"),
        hashed(pii_hash("email_address"), "email_address_hash", "email_address"),
        hashed(pii_hash("phone"), "phone_hash", "phone"),
        INGESTED_AT, SOURCE_SYSTEM, "_dbt_loaded_at",
    )


@model("int_pii_vault_employees", "intermediate", "view", depends_on=("stg_hr__employees",),
       tags=("pii_vault", "restricted", "local_only"), unique_key=("business_entity_id",),
       pii_fields=("national_id_number", "login_id", "birth_date"), pii_free=False)
def int_pii_vault_employees(run: Run) -> DataFrame:
    """Restricted: clear-text employee PII beside its keys and raw-value hashes."""
    return run.ref("stg_hr__employees").select(
        surrogate_key(["business_entity_id"]).alias("employee_sk"),
        "business_entity_id", "national_id_number", "login_id", "birth_date",
        *_employee_hashes(), *EMPLOYEE_WORK,
        INGESTED_AT, SOURCE_SYSTEM, "_dbt_loaded_at",
    )


# ---------------------------------------------------------------------------
# certified (change-data-capture tables + one rebuilt fact)
# ---------------------------------------------------------------------------

def _certified(df: DataFrame, run: Run, *cols) -> DataFrame:
    return df.select(*cols, *CDC_LINEAGE, loaded_at(run.run_ts))


def az_customers_project(run: Run) -> Callable[[DataFrame], DataFrame]:
    return lambda s: _certified(
        s, run,
        surrogate_key(["customer_id"]).alias("customer_sk"),
        "customer_id", "person_id", "store_id", "territory_id", "account_number",
        hashed(pii_hash("name"), "full_name_hash", "name"),
        hashed(pii_hash("email_address"), "email_address_hash", "email_address"),
        hashed(pii_hash("phone"), "phone_hash", "phone"),
    )


def az_addresses_project(run: Run) -> Callable[[DataFrame], DataFrame]:
    return lambda s: _certified(
        s, run,
        "address_id", "customer_id", surrogate_key(["customer_id"]).alias("customer_sk"),
        "state_province_id",
        hashed(pii_hash("address_line1"), "address_line1_hash", "address_line1"),
        hashed(pii_hash("address_line2"), "address_line2_hash", "address_line2"),
        "city", "postal_code", "country_region",
    )


def az_order_headers_project(run: Run) -> Callable[[DataFrame], DataFrame]:
    return lambda s: _certified(
        s, run,
        "sales_order_id", "customer_id", surrogate_key(["customer_id"]).alias("customer_sk"),
        "sales_person_id", "territory_id", "revision_number", "sales_order_number",
        "purchase_order_number", "account_number", "order_date", "due_date", "ship_date",
        "status", "online_order_flag", "sub_total", "tax_amt", "freight", "total_due",
    )


def az_order_details_project(run: Run) -> Callable[[DataFrame], DataFrame]:
    return lambda s: _certified(
        s, run,
        "sales_order_id", "sales_order_detail_id", "product_id", "special_offer_id",
        "carrier_tracking_number", "order_qty", "unit_price", "unit_price_discount", "line_total",
    )


def az_products_project(run: Run) -> Callable[[DataFrame], DataFrame]:
    return lambda s: _certified(
        s, run,
        "product_id", "product_number", "product_name", "standard_cost", "list_price",
        "finished_goods_flag", "color", "size", "weight", "safety_stock_level", "reorder_point",
    )


def az_employees_project(run: Run) -> Callable[[DataFrame], DataFrame]:
    return lambda s: _certified(
        s, run,
        surrogate_key(["business_entity_id"]).alias("employee_sk"),
        "business_entity_id", *_employee_hashes(), *EMPLOYEE_WORK,
    )


def az_departments_project(run: Run) -> Callable[[DataFrame], DataFrame]:
    return lambda s: _certified(
        s, run,
        "department_id", F.col("name").alias("department_name"),
        F.col("group_name").alias("department_group"),
    )


CDC_MODELS = {
    # certified model: (staging model, entity, projection factory)
    "az_customers": ("stg_crm__customers", "customers", az_customers_project),
    "az_addresses": ("stg_crm__addresses", "addresses", az_addresses_project),
    "az_order_headers": ("stg_erp__order_headers", "order_headers", az_order_headers_project),
    "az_order_details": ("stg_erp__order_details", "order_details", az_order_details_project),
    "az_products": ("stg_erp__products", "products", az_products_project),
    "az_employees": ("stg_hr__employees", "employees", az_employees_project),
    "az_departments": ("stg_hr__departments", "departments", az_departments_project),
}


def _cdc_model(name: str, staging: str, entity: str, project_factory):
    @model(name, "certified", "incremental", depends_on=(staging,), unique_key=ENTITIES[entity].key)
    def build(run: Run) -> DataFrame:
        return apply_changes(
            run.staged_by_key(name), run.previous(name), ENTITIES[entity].key,
            project=project_factory(run), validate_keys=run.validate_keys,
        )

    return build


for _name, (_stg, _entity, _factory) in CDC_MODELS.items():
    globals()[_name] = _cdc_model(_name, _stg, _entity, _factory)


@model("az_orders", "certified", "table", depends_on=("int_orders",),
       unique_key=("sales_order_id", "sales_order_detail_id"))
def az_orders(run: Run) -> DataFrame:
    """Analytic order fact, rebuilt in full each run; no customer id, no PII."""
    return run.ref("int_orders").select(
        "sales_order_id", "sales_order_detail_id", "sales_order_number", "customer_sk",
        "order_date", "due_date", "ship_date", "status", "online_order_flag", "product_id",
        "order_qty", "unit_price", "unit_price_discount", "line_total", "line_total_net",
        "discount_amount", "sub_total", "total_due",
        INGESTED_AT, SOURCE_SYSTEM, PIPELINE_NAME, BATCH_ID, "_dbt_loaded_at",
    )


# Fixed model metadata as declared for the project.
_META = {
    "int_customers": {"access": "internal"},
    "int_employees": {"access": "internal"},
    "int_pii_vault_customers": {"access": "restricted", "pii_vault": True, "never_export": True},
    "int_pii_vault_employees": {"access": "restricted", "pii_vault": True, "never_export": True},
    "az_customers": {"contract_status": "visado", "pii_vault": "int_pii_vault_customers"},
    "az_addresses": {"contract_status": "visado"},
    "az_order_headers": {"contract_status": "visado"},
    "az_order_details": {"contract_status": "visado"},
    "az_products": {"contract_status": "visado"},
    "az_employees": {"contract_status": "visado", "pii_vault": "int_pii_vault_employees"},
    "az_departments": {"contract_status": "visado", "small": True},
    "az_orders": {"contract_status": "visado"},
}
for _name, _fields in _META.items():
    MODELS[_name] = replace(MODELS[_name], **_fields)


def topological_order(names=None) -> list[str]:
    """Model names with every dependency before its dependants."""
    names = list(MODELS) if names is None else list(names)
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in MODELS[n].depends_on:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    wanted = set(names)
    return [n for n in seen if n in wanted]
