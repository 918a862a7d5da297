import hashlib
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions import (
    EMPTY_SHA256, clean_lower, clean_upper, clip, concat_nullsafe, concat_strict, date_text,
    discount_amount, line_total_net, pii_hash, row_fingerprint, surrogate_key,
)

# Golden values of the published hashes.
JOHN_DOE_UTF16 = "B3DC648AB2C85949B6CF55DE19FF79EE8D85B0315C4350F28C1EA6A0EB6FB28A"
JOHN_DOE_UTF8 = "6CEA57C2FB6CBC2A40411135005760F241FFFC3E5E67AB99882726431037F908"
SK_29825 = "f0e37e9e9b28f94f89e67d28df74c2b4"


def one(spark, col, schema="s string", row=("John Doe",)):
    return spark.createDataFrame([row], schema).select(col.alias("v")).first()["v"]


def test_pii_hash_golden(spark):
    assert one(spark, pii_hash("s")) == JOHN_DOE_UTF16
    assert one(spark, pii_hash("s", encoding="UTF-8")) == JOHN_DOE_UTF8


def test_pii_hash_null_equals_empty(spark):
    df = spark.createDataFrame([(None,), ("",)], "s string")
    assert {r.v for r in df.select(pii_hash("s").alias("v")).collect()} == {EMPTY_SHA256}


def test_pii_hash_non_ascii_is_utf16le(spark):
    text = "  José Müller  "
    expected = hashlib.sha256(text.encode("utf-16-le")).hexdigest().upper()
    assert one(spark, pii_hash("s"), row=(text,)) == expected


def test_pii_hash_salt_changes_digest(spark):
    assert one(spark, pii_hash("s", salt="k")) != JOHN_DOE_UTF16


def test_surrogate_key_golden_and_composite(spark):
    assert one(spark, surrogate_key(["i"]), "i int", (29825,)) == SK_29825
    expected = hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()
    assert one(spark, surrogate_key(["a", "b"]), "a int, b int", (1, None)) == expected


def test_row_fingerprint(spark):
    df = spark.createDataFrame([(7, None, "x")], "a int, b string, c string")
    got = df.select(row_fingerprint(["a", "b", "c"]).alias("v")).first()["v"]
    assert got == hashlib.sha256("7||x".encode("utf-16-le")).hexdigest().upper()
    latin = df.select(row_fingerprint(["a", "b", "c"], encoding="ISO-8859-1").alias("v")).first()["v"]
    assert latin == hashlib.sha256(b"7||x").hexdigest().upper()


def test_clip_and_cleaning(spark):
    assert one(spark, clip("s", 4)) == "John"
    assert one(spark, clean_upper("s"), row=("  ana\t ",)) == "ANA\t"
    assert one(spark, clean_lower("s"), row=(" A@B.COM ",)) == "a@b.com"


def test_concat_null_semantics(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    r = df.select(concat_nullsafe("a", "b").alias("x"), concat_strict("a", "b").alias("y")).first()
    assert r.x == "a" and r.y is None


def test_date_text(spark):
    assert one(spark, date_text("d"), "d date", (date(1980, 2, 29),)) == "1980-02-29"


def test_decimal_maths(spark):
    df = spark.createDataFrame([(3, Decimal("2.5555"), Decimal("0.1234"))],
                               "q short, p decimal(18,4), d decimal(6,4)")
    r = df.select(line_total_net("q", "p", "d").alias("n"), discount_amount("q", "p", "d").alias("a"))
    row = r.first()
    assert r.schema["n"].dataType == T.DecimalType(38, 6)
    assert row.n == Decimal("6.720454")
    assert row.a == Decimal("0.946046")
