"""Publishing rules: the PII leak check, excluded tags and layer schemas.

Tables are written by :class:`~lakeward.operators.table_store.TableStore`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def pii_columns(models: Mapping[str, object]) -> set[str]:
    """Every clear-text PII column name declared by any model."""
    cols: set[str] = set()
    for info in models.values():
        cols.update(getattr(info, "pii_fields", ()))
    return cols


def leak_check(published: Mapping[str, DataFrame], pii: set[str]) -> list[tuple[str, str]]:
    """``(model, column)`` pairs where a published table carries a PII column.

    Reads schemas only; an empty list means nothing personal is published.
    """
    return sorted((name, c) for name, df in published.items() for c in df.columns if c in pii)


def excluded(tags: Iterable[str], exclude_tags: Iterable[str]) -> bool:
    return bool(set(tags) & set(exclude_tags))


def schema_name(custom_schema: str | None, default_schema: str) -> str:
    """Layer schema used verbatim (no target prefix); the default when unset."""
    return default_schema if custom_schema is None else custom_schema.strip()


def table_path(base: str, layer_schema: str | None, name: str, default_schema: str = "dbo") -> str:
    """``<base>/<schema>/<name>`` for a model written in ``layer_schema``."""
    return f"{base.rstrip('/')}/{schema_name(layer_schema, default_schema)}/{name}"
