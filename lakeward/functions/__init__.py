"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from lakeward.functions.decimals import discount_amount, line_total_net
from lakeward.functions.hashing import (
    EMPTY_SHA256,
    pii_hash,
    row_fingerprint,
    sha256_hex,
    surrogate_key,
)
from lakeward.functions.text import (
    as_text,
    clean_lower,
    clean_upper,
    clip,
    concat_nullsafe,
    concat_strict,
    date_text,
    trim_spaces,
)

__all__ = [
    "EMPTY_SHA256",
    "as_text",
    "clean_lower",
    "clean_upper",
    "clip",
    "concat_nullsafe",
    "concat_strict",
    "date_text",
    "discount_amount",
    "line_total_net",
    "pii_hash",
    "row_fingerprint",
    "sha256_hex",
    "surrogate_key",
    "trim_spaces",
]
