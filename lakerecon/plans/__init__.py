from .batch import run_batch, run_sql_step
from .ingest import IngestResult, ingest_history
from .load import load_frame, load_history
from .registered import compact_evolved, compact_registered
from .reconcile import (
    PublishedRecon,
    ReconRun,
    RowRecon,
    prepare_source,
    prepare_target,
    publish_count_control,
    publish_recon,
    recon_run,
    row_recon,
    run_count_controls,
)
from .state import BucketedTable, recon_tables

__all__ = [
    "BucketedTable",
    "recon_tables",
    "PublishedRecon",
    "ReconRun",
    "publish_count_control",
    "recon_run",
    "compact_evolved",
    "compact_registered",
    "publish_recon",
    "IngestResult",
    "RowRecon",
    "ingest_history",
    "load_frame",
    "load_history",
    "prepare_source",
    "prepare_target",
    "row_recon",
    "run_batch",
    "run_count_controls",
    "run_sql_step",
]
