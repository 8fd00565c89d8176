from .align import (
    align_names,
    align_types,
    as_local_timestamp,
    normalise_ts,
    project_exprs,
    redact,
    tag,
    timestamps_as_text,
    within_window,
)
from .lattice import Join, join_types, reader_lattice
from .payload import extract_keys, flatten_payload, rows_as_json, split_payload, unbox
from .times import eastern_text, eastern_time, recon_dates, recon_window

__all__ = [
    "Join",
    "join_types",
    "reader_lattice",
    "align_names",
    "align_types",
    "as_local_timestamp",
    "eastern_text",
    "eastern_time",
    "extract_keys",
    "flatten_payload",
    "normalise_ts",
    "project_exprs",
    "recon_dates",
    "recon_window",
    "redact",
    "rows_as_json",
    "split_payload",
    "tag",
    "timestamps_as_text",
    "unbox",
    "within_window",
]
