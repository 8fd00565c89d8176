from .bitmaps import bitmap_cost, count_keys, key_bitmaps, merge_bitmaps, missing_keys, missing_records_bitmap
from .compaction import compact, compact_calendar, rekey_calendar_paths
from .compare import column_diff, compare_rows, diff_text, missing_records, recon_summary
from .counts import count_recon, drill_counts, failed_groups, recon_alerts
from .digest import DigestRecon, recon_by_digest
from .drift import SchemaRegistry, latest_schema, payload_schema, schema_diff, schemas_by_partition
from .hotkeys import HotKeys, find_hot_keys, join_to_unique
from .latest import latest_per_key
from .layout import cap_partitions, compaction_plan, grow_partitions, pending_partitions
from .packing import PackedResult, compact_packed, pack_files
from .quality import append_failures, rule_summary, run_fused, run_rules
from .stats import counted, distinct_keys, landing_stats, row_count

__all__ = [
    "DigestRecon",
    "PackedResult",
    "bitmap_cost",
    "count_keys",
    "key_bitmaps",
    "merge_bitmaps",
    "missing_keys",
    "missing_records_bitmap",
    "recon_by_digest",
    "HotKeys",
    "SchemaRegistry",
    "append_failures",
    "cap_partitions",
    "column_diff",
    "compact",
    "compact_calendar",
    "compact_packed",
    "compaction_plan",
    "compare_rows",
    "count_recon",
    "counted",
    "diff_text",
    "distinct_keys",
    "drill_counts",
    "failed_groups",
    "find_hot_keys",
    "grow_partitions",
    "join_to_unique",
    "landing_stats",
    "latest_per_key",
    "latest_schema",
    "missing_records",
    "payload_schema",
    "pack_files",
    "pending_partitions",
    "recon_alerts",
    "recon_summary",
    "rekey_calendar_paths",
    "row_count",
    "rule_summary",
    "run_fused",
    "run_rules",
    "schema_diff",
    "schemas_by_partition",
]
