"""Run (a selection of) the project: build models in dependency order and
write the tables into a :class:`~lakeward.operators.table_store.TableStore`.

Selection mirrors the usual model selectors: a layer or the schema it is
written to (``staging``, ``intermediate``, ``certified`` or
``azure_fabric``), a model name, ``+name`` (the model and everything
upstream), ``name+`` (the model and everything downstream), ``+name+`` (both)
and ``tag:<tag>``.  A selector that matches no model is an error.  ``exclude_tags`` drops
models carrying any of the tags (e.g. ``local_only`` vaults are never
published).  Views are not written: dependants read them lazily.  After a
table is written its dependants read the written copy, which keeps each
stage's plan short.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame

from lakeward.operators.cdc import apply_changes
from lakeward.operators.lineage import clear_columns
from lakeward.operators.publish import excluded, leak_check, pii_columns
from lakeward.operators.table_store import TableStore
from lakeward.plans.models import CDC_MODELS, MODELS, Run, topological_order
from lakeward.sources.schemas import ENTITIES


#: Fixed value: the schema that the certified layer is written to.
SCHEMA_LAYER = {"azure_fabric": "certified"}
LAYER_SCHEMA = {layer: schema for schema, layer in SCHEMA_LAYER.items()}


def _downstream(name: str) -> set[str]:
    out = {name}
    changed = True
    while changed:
        changed = False
        for m, info in MODELS.items():
            if m not in out and set(info.depends_on) & out:
                out.add(m)
                changed = True
    return out


def _upstream(name: str) -> set[str]:
    out = {name}
    stack = [name]
    while stack:
        for d in MODELS[stack.pop()].depends_on:
            if d not in out:
                out.add(d)
                stack.append(d)
    return out


def _matching(selector: str) -> set[str]:
    if selector.startswith("tag:"):
        found = {m for m, i in MODELS.items() if selector[4:] in i.tags}
    else:
        name = selector.strip("+")
        layer = SCHEMA_LAYER.get(name, name)
        roots = {name} & set(MODELS) or {m for m, i in MODELS.items() if i.layer == layer}
        found = set(roots)
        for m in roots:
            if selector.startswith("+"):
                found |= _upstream(m)
            if selector.endswith("+"):
                found |= _downstream(m)
    if not found:
        raise KeyError(f"selector {selector!r} matches no model")
    return found


def select_models(select: Iterable[str] | None = None, exclude_tags: Iterable[str] = ()) -> list[str]:
    """Model names matching the selectors, in dependency order."""
    chosen: set[str] = set()
    for s in (list(MODELS) if select is None else select):
        chosen |= _matching(s)
    return [m for m in topological_order(chosen) if not excluded(MODELS[m].tags, exclude_tags)]


def schema_of(name: str) -> str:
    """The schema a model's table is written to: its layer's."""
    return LAYER_SCHEMA.get(MODELS[name].layer, MODELS[name].layer)


def _changed(run: Run, name: str):
    """The certified state of some staged and published rows, as :meth:`TableStore.upsert` asks for it."""
    _, entity, project = CDC_MODELS[name]
    return lambda staged, published: apply_changes(
        staged, published, ENTITIES[entity].key, project=project(run), validate_keys=run.validate_keys,
        with_change_type=True, with_deletes=False)


def run_project(
    store: TableStore,
    raw: Callable[..., DataFrame],
    run_ts: datetime,
    select: Iterable[str] | None = None,
    exclude_tags: Iterable[str] = ("local_only",),
    full_refresh: bool = False,
    validate_keys: bool = True,
    laid: bool = False,
) -> dict[str, dict[str, int]]:
    """Build the selected models and write their tables, each to its layer's schema.

    Returns the rows by change type of each table; a full write inserts all
    its rows, and an incremental table without changes has none.  Refuses to
    publish if a written table would carry a clear-text PII column of any model,
    by its name or by where its values come from.  ``laid`` says that raw tables
    are the store's own, and certified tables get as many buckets of the same
    keys, so they are written without an exchange; ``raw`` then takes a second
    argument too, the buckets whose rows it gives.
    """
    run = Run(raw=raw, run_ts=run_ts, validate_keys=validate_keys)
    names = select_models(select, exclude_tags)
    written: dict[str, dict[str, int]] = {}
    pii = pii_columns(MODELS)
    for name in names:
        info = MODELS[name]
        if info.never_export:
            raise ValueError(f"{name} is declared never_export and cannot be published")
        if info.materialized == "view":
            continue
        df = run.ref(name)  # as a first load writes it
        leaks = leak_check({name: df}, pii) or [(name, c) for c in clear_columns(df)]
        if leaks:
            raise ValueError(f"refusing to publish PII columns: {leaks}")
        schema = schema_of(name)
        if info.materialized == "incremental" and not full_refresh and store.current(schema, name) is not None:
            staging = CDC_MODELS[name][0]
            of_parts = lambda parts: Run(raw=lambda e: raw(e, parts), run_ts=run_ts).ref(staging)  # noqa: B023, E731
            written[name] = store.upsert(schema, name, run.ref(staging), info.unique_key, _changed(run, name), mirror=True,
                                         laid=laid, of_parts=of_parts if laid else None, validate_keys=validate_keys)
        else:
            as_raw = laid and name in CDC_MODELS
            buckets = store.buckets_of(*raw_table(name)) if as_raw else bucket_number(store, name)
            rows = store.replace(schema, name, df, info.unique_key, buckets=buckets, validate_keys=validate_keys, laid=as_raw)
            written[name] = {"insert": rows}
        run.pin(name, store.current(schema, name))
    return written


def raw_table(name: str) -> tuple[str, str]:
    """Schema and name of the landed table that a certified table is made of."""
    spec = ENTITIES[CDC_MODELS[name][1]]
    return spec.raw_schema_name, spec.name


def bucket_number(store: TableStore, name: str) -> int | None:
    """Small reference tables take one bucket, the others the store's number."""
    return 1 if MODELS[name].small else None
