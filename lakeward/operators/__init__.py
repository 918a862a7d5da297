"""DataFrame -> DataFrame operators of the pipeline."""

from lakeward.operators.audit import batch_audit, load_summary, tables_per_layer
from lakeward.operators.cdc import (
    apply_changes,
    apply_changes_stepwise,
    change_counts,
    classify_changes,
    delete_orphans,
    detect_changes,
    merge_changes,
    sync_columns,
)
from lakeward.operators.contracts import (
    accepted_values,
    expression_is_true,
    gate,
    not_null,
    relationships,
    run_contracts,
    unique,
    unique_combination,
)
from lakeward.operators.dedupe import dedupe_latest
from lakeward.operators.freshness import check_freshness, freshness
from lakeward.operators.joins import left_join_split_nulls, left_join_spread
from lakeward.operators.keys import DuplicateKeyError, assert_unique_keys, guard_unique
from lakeward.operators.landing import (
    LoadStamp,
    append_stamp,
    landing_merge,
    landing_merge_feed,
    landing_reload,
    rows_affected,
    stamp,
)
from lakeward.operators.publish import leak_check, table_path
from lakeward.operators.staging import live_rows, stage
from lakeward.operators.table_store import TableStore, bucket_digests
from lakeward.operators.vault import cross_verify, lookup, lookup_by_clear_value

__all__ = [
    "DuplicateKeyError", "LoadStamp", "accepted_values", "append_stamp", "apply_changes",
    "apply_changes_stepwise", "assert_unique_keys", "batch_audit", "change_counts",
    "check_freshness", "classify_changes", "cross_verify", "dedupe_latest", "delete_orphans", "detect_changes",
    "expression_is_true", "freshness", "gate", "guard_unique", "landing_merge", "landing_merge_feed",
    "landing_reload", "leak_check", "left_join_split_nulls", "left_join_spread", "live_rows", "load_summary", "lookup",
    "lookup_by_clear_value", "merge_changes", "not_null", "relationships", "rows_affected", "run_contracts",
    "stage", "stamp", "sync_columns", "table_path", "TableStore", "bucket_digests", "tables_per_layer", "unique", "unique_combination",
]
