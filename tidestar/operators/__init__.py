"""DataFrame operators: dedup, dimensions, facts, history, skew-safe joins."""

from tidestar.operators.dedup import dedup_changes, has_null_timestamps
from tidestar.operators.dimensions import (
    CUSTOMER,
    PRODUCT,
    Dimension,
    build_dim_customer,
    build_dim_date,
    build_dim_product,
)
from tidestar.operators.facts import build_fact_orders, delete_facts, fact_rejects, facts_of, judged_items, with_totals
from tidestar.operators.feed_diff import BUCKETS, changed_buckets, digests, snapshot_diff, snapshot_diff_by_digest
from tidestar.operators.schema_ops import align_to, evolve_union, schema_mismatches
from tidestar.operators.scd2 import (
    dim_date_upsert,
    scd2_append,
    scd2_changes,
    scd2_history,
    scd2_merge,
)
from tidestar.operators.skew import SkewPolicy, heavy_keys, keyed_join

__all__ = [
    "BUCKETS", "CUSTOMER", "PRODUCT", "Dimension", "SkewPolicy", "align_to", "build_dim_customer",
    "build_dim_date", "build_dim_product", "build_fact_orders", "changed_buckets", "dedup_changes", "delete_facts",
    "digests", "dim_date_upsert", "evolve_union", "fact_rejects", "facts_of", "has_null_timestamps", "heavy_keys",
    "judged_items", "keyed_join", "scd2_append", "scd2_changes", "scd2_history", "scd2_merge",
    "schema_mismatches", "snapshot_diff", "snapshot_diff_by_digest", "with_totals",
]
