"""Hash columns: one-way PII hashes, row fingerprints and surrogate keys.

All three are plain ``Column`` expressions built from Spark's own
``sha2`` / ``md5`` / ``encode`` functions, so they stay inside
whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeward.functions.text import as_text

# Fixed values that the published hashes depend on.
# - Text is hashed as UTF-16LE by default: the source system hashes
#   NVARCHAR values, whose bytes are UTF-16LE.
# - Fingerprint parts are joined with a single '|'.
# - Surrogate keys use the md5 of the parts joined by '-', with NULL
#   parts replaced by the marker '_dbt_utils_surrogate_key_null_'.
DEFAULT_ENCODING = "UTF-16LE"
FINGERPRINT_SEPARATOR = "|"
SURROGATE_SEPARATOR = "-"
SURROGATE_NULL_MARKER = "_dbt_utils_surrogate_key_null_"

# SHA-256 of the empty string: the hash every absent value shares.
EMPTY_SHA256 = "E3B0C44298FC1C149AFBF4C8996FB92427AE41E4649B934CA495991B7852B855"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha256_hex(text: Column, encoding: str = DEFAULT_ENCODING) -> Column:
    """Upper-case hex SHA-256 of ``text`` encoded with ``encoding``."""
    return F.upper(F.sha2(F.encode(text, encoding), 256))


def pii_hash(c: str | Column, encoding: str = DEFAULT_ENCODING, salt: str | None = None) -> Column:
    """One-way hash of a single personal value.

    NULL and '' hash alike (the value is coalesced to ''), so every absent
    value maps to :data:`EMPTY_SHA256`.  ``salt`` (off by default, for
    parity) prefixes a secret so low-entropy values are not guessable.
    """
    text = F.coalesce(as_text(_col(c)), F.lit(""))
    if salt:
        text = F.concat(F.lit(salt), text)
    return sha256_hex(text, encoding)


def row_fingerprint(
    cols: Sequence[str | Column],
    encoding: str = DEFAULT_ENCODING,
    separator: str = FINGERPRINT_SEPARATOR,
) -> Column:
    """Change-detection fingerprint over ``cols``.

    Each part is rendered as text with NULL as '', the parts are joined by
    ``separator`` and the SHA-256 of the joined text is returned as
    upper-case hex.  Use ``encoding="ISO-8859-1"`` for single-byte text.
    """
    parts = [F.coalesce(as_text(_col(c)), F.lit("")) for c in cols]
    return sha256_hex(F.concat_ws(separator, *parts), encoding)


def surrogate_key(cols: Sequence[str | Column]) -> Column:
    """Deterministic lower-case md5 key over one or more columns."""
    parts = [F.coalesce(as_text(_col(c)), F.lit(SURROGATE_NULL_MARKER)) for c in cols]
    joined = parts[0] if len(parts) == 1 else F.concat_ws(SURROGATE_SEPARATOR, *parts)
    return F.md5(joined)
