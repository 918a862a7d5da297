"""Declarative specs for the seven landed entities.

One :class:`EntitySpec` per raw table holds everything the generic
operators need: the raw ``StructType`` (payload + lineage), the typed
staging projection, the primary key, the landing fingerprint recipe, the
columns a landing upsert may overwrite, and the freshness thresholds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.text import clip

# ---------------------------------------------------------------------------
# Lineage columns carried by every raw table (fixed names and types).
# ---------------------------------------------------------------------------
INGESTED_AT = "_ingested_at"
SOURCE_SYSTEM = "_source_system"
SOURCE_ENTITY = "_source_entity"
PIPELINE_NAME = "_pipeline_name"
BATCH_ID = "_batch_id"
RAW_HASH = "_raw_hash"
IS_DELETED = "_is_deleted"
LOADED_AT = "_dbt_loaded_at"

LINEAGE_FIELDS = [
    T.StructField(INGESTED_AT, T.TimestampNTZType(), False),
    T.StructField(SOURCE_SYSTEM, T.StringType(), False),
    T.StructField(SOURCE_ENTITY, T.StringType(), False),
    T.StructField(PIPELINE_NAME, T.StringType(), False),
    T.StructField(BATCH_ID, T.StringType(), False),
    T.StructField(RAW_HASH, T.StringType(), True),
    T.StructField(IS_DELETED, T.BooleanType(), False),
]
LINEAGE = [f.name for f in LINEAGE_FIELDS]


@dataclass(frozen=True)
class Field:
    """One payload column: its raw type and its staged (typed) projection."""

    name: str
    raw_type: T.DataType
    stage: Callable[[Column], Column]
    staged_type: T.DataType

    def staged(self) -> Column:
        return self.stage(F.col(self.name)).alias(self.name)


def int_(name: str) -> Field:
    return Field(name, T.IntegerType(), lambda c: c.cast(T.IntegerType()), T.IntegerType())


def short_(name: str) -> Field:
    # SMALLINT, and also TINYINT: T-SQL TINYINT is unsigned 0-255, which
    # does not fit Spark's signed ByteType, so both map to ShortType.
    return Field(name, T.ShortType(), lambda c: c.cast(T.ShortType()), T.ShortType())


def varchar(name: str, staged_len: int) -> Field:
    return Field(name, T.StringType(), lambda c: clip(c, staged_len), T.StringType())


def date_(name: str, raw_type: T.DataType = T.DateType()) -> Field:
    return Field(name, raw_type, lambda c: c.cast(T.DateType()), T.DateType())


def bit(name: str) -> Field:
    return Field(name, T.BooleanType(), lambda c: c.cast(T.BooleanType()), T.BooleanType())


def dec(name: str, precision: int, scale: int, raw: T.DecimalType = T.DecimalType(19, 4)) -> Field:
    target = T.DecimalType(precision, scale)
    return Field(name, raw, lambda c: c.cast(target), target)


@dataclass(frozen=True)
class EntitySpec:
    name: str                      # raw table name, e.g. "customers"
    system: str                    # source system, e.g. "crm"
    key: tuple[str, ...]           # primary key (NOT NULL, unique)
    fields: tuple[Field, ...]      # payload columns in declared order
    fingerprint: tuple[str, ...]   # columns the landing fingerprint covers
    fingerprint_encoding: str      # "UTF-16LE" (NVARCHAR) or "ISO-8859-1" (VARCHAR)
    update_columns: tuple[str, ...]  # payload a landing upsert may overwrite
    freshness_warn_days: int = 1
    freshness_error_days: int = 3
    pii: tuple[str, ...] = ()      # clear-text personal fields
    extra: dict = field(default_factory=dict)

    @property
    def raw_schema_name(self) -> str:
        return f"raw_{self.system}"

    @property
    def pipeline_name(self) -> str:
        return f"pl_load_{self.system}_{self.name}_full"

    @property
    def payload(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def raw_schema(self) -> T.StructType:
        payload = [T.StructField(f.name, f.raw_type, f.name not in self.key) for f in self.fields]
        return T.StructType(payload + LINEAGE_FIELDS)

    @property
    def staged_columns(self) -> list[str]:
        return self.payload + LINEAGE + [LOADED_AT]


TS = T.TimestampNTZType()

CUSTOMERS = EntitySpec(
    name="customers",
    system="crm",
    key=("customer_id",),
    fields=(
        int_("customer_id"), int_("person_id"), int_("store_id"), int_("territory_id"),
        varchar("account_number", 20), varchar("name", 200),
        varchar("email_address", 150), varchar("phone", 30),
    ),
    fingerprint=("customer_id", "account_number", "name", "email_address", "phone"),
    fingerprint_encoding="UTF-16LE",
    update_columns=("person_id", "store_id", "territory_id", "account_number", "name",
                    "email_address", "phone"),
    pii=("name", "email_address", "phone"),
)

ADDRESSES = EntitySpec(
    name="addresses",
    system="crm",
    key=("address_id",),
    fields=(
        int_("address_id"), int_("customer_id"), int_("state_province_id"),
        varchar("address_line1", 200), varchar("address_line2", 200), varchar("city", 100),
        varchar("postal_code", 20), varchar("country_region", 100),
    ),
    fingerprint=("address_id", "address_line1", "city", "postal_code"),
    fingerprint_encoding="UTF-16LE",
    update_columns=("customer_id", "address_line1", "address_line2", "city",
                    "state_province_id", "postal_code", "country_region"),
    pii=("address_line1", "address_line2"),
)

ORDER_HEADERS = EntitySpec(
    name="order_headers",
    system="erp",
    key=("sales_order_id",),
    fields=(
        int_("sales_order_id"), int_("customer_id"), int_("sales_person_id"), int_("territory_id"),
        short_("revision_number"), varchar("sales_order_number", 25),
        varchar("purchase_order_number", 25), varchar("account_number", 20),
        date_("order_date", TS), date_("due_date", TS), date_("ship_date", TS),
        short_("status"), bit("online_order_flag"),
        dec("sub_total", 18, 4), dec("tax_amt", 18, 4), dec("freight", 18, 4), dec("total_due", 18, 4),
    ),
    fingerprint=("sales_order_id", "revision_number", "status", "total_due"),
    fingerprint_encoding="ISO-8859-1",
    update_columns=("revision_number", "status", "ship_date", "sub_total", "tax_amt",
                    "freight", "total_due"),
)

ORDER_DETAILS = EntitySpec(
    name="order_details",
    system="erp",
    key=("sales_order_id", "sales_order_detail_id"),
    fields=(
        int_("sales_order_id"), int_("sales_order_detail_id"), int_("product_id"),
        int_("special_offer_id"), varchar("carrier_tracking_number", 50), short_("order_qty"),
        dec("unit_price", 18, 4), dec("unit_price_discount", 6, 4), dec("line_total", 18, 4),
    ),
    fingerprint=("sales_order_id", "sales_order_detail_id", "order_qty", "line_total"),
    fingerprint_encoding="ISO-8859-1",
    update_columns=("order_qty", "unit_price", "unit_price_discount", "line_total"),
)

PRODUCTS = EntitySpec(
    name="products",
    system="erp",
    key=("product_id",),
    fields=(
        int_("product_id"), varchar("product_number", 25), varchar("product_name", 200),
        dec("standard_cost", 18, 4), dec("list_price", 18, 4), bit("finished_goods_flag"),
        varchar("color", 50), varchar("size", 10), dec("weight", 8, 2, T.DecimalType(8, 2)),
        short_("safety_stock_level"), short_("reorder_point"),
    ),
    fingerprint=("product_id", "product_number", "product_name", "standard_cost", "list_price"),
    fingerprint_encoding="UTF-16LE",
    update_columns=("product_number", "product_name", "standard_cost", "list_price", "color"),
    freshness_warn_days=7,
    freshness_error_days=30,
)

EMPLOYEES = EntitySpec(
    name="employees",
    system="hr",
    key=("business_entity_id",),
    fields=(
        int_("business_entity_id"), varchar("national_id_number", 25), varchar("login_id", 100),
        varchar("job_title", 100), date_("birth_date"), varchar("marital_status", 1),
        varchar("gender", 1), date_("hire_date"), bit("salaried_flag"),
        short_("vacation_hours"), short_("sick_leave_hours"),
    ),
    fingerprint=("business_entity_id", "national_id_number", "job_title", "hire_date"),
    fingerprint_encoding="UTF-16LE",
    update_columns=("job_title", "vacation_hours", "sick_leave_hours"),
    pii=("national_id_number", "login_id", "birth_date"),
)

DEPARTMENTS = EntitySpec(
    name="departments",
    system="hr",
    key=("department_id",),
    fields=(short_("department_id"), varchar("name", 100), varchar("group_name", 100)),
    fingerprint=("department_id", "name", "group_name"),
    fingerprint_encoding="UTF-16LE",
    update_columns=("name", "group_name"),
    freshness_warn_days=7,
    freshness_error_days=30,
)

ENTITIES: dict[str, EntitySpec] = {
    s.name: s
    for s in (CUSTOMERS, ADDRESSES, ORDER_HEADERS, ORDER_DETAILS, PRODUCTS, EMPLOYEES, DEPARTMENTS)
}
