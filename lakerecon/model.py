"""Typed specifications: one object per job section, validated when it is built."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql.types import StructType

__all__ = [
    "AuditStamp",
    "BatchSpec",
    "CompactionSpec",
    "CountReconSpec",
    "DQRule",
    "FILE_TIERS",
    "FIXED_FILES",
    "IngestSpec",
    "LoadSpec",
    "PARTITION_COLUMN",
    "OrphanRule",
    "ROWS_PER_FILE",
    "ReconSpec",
    "RowRule",
    "UniqueRule",
]

PARTITION_COLUMN = "event_creation_time"

# Rows per compacted file, and the (rows up to, files) tiers.
ROWS_PER_FILE = 10_000
FILE_TIERS = ((1_000, 10), (3_000, 30), (5_000, 50), (None, 200))
FIXED_FILES = ((None, 10),)

# A reader or writer task should not be handed more rows than this, whatever the tiers say.
MAX_ROWS_PER_FILE = 20_000_000


@dataclass(frozen=True)
class ReconSpec:
    """Row reconciliation of a source feed against a serving table."""

    table: str
    keys: Sequence[str]
    source_fields: Sequence[str]
    target_fields: Sequence[str]
    compare: Sequence[str] = ()
    expressions: Mapping[str, str] = field(default_factory=dict)
    timestamps: Sequence[str] = ()
    tie_break: Sequence[str] | None = None
    hours: int = 24

    def __post_init__(self):
        if not self.keys or not self.source_fields:
            raise ValueError("keys and source_fields are required")
        if len(self.source_fields) != len(self.target_fields):
            raise ValueError("source_fields and target_fields must pair up")

    @property
    def event_time(self) -> str:
        """The first field carries the event time on both sides."""
        return self.source_fields[0]

    @property
    def compared_columns(self) -> list[str]:
        return [c for c in (self.compare or self.source_fields) if c not in self.keys]


@dataclass(frozen=True)
class CountReconSpec:
    """One control that compares grouped counts of two queries."""

    control: str
    table: str
    left_sql: str
    right_sql: str
    keys: Sequence[str]
    audit_fields: Sequence[str] = ()


@dataclass(frozen=True)
class DQRule:
    """A rule is a query that returns the rows violating it."""

    name: str
    sql: str
    fields: Sequence[str]

    def __post_init__(self):
        if not self.fields:
            raise ValueError(f"rule {self.name} names no fields to keep")


@dataclass(frozen=True)
class RowRule:
    """Rows of ``table`` for which the SQL expression ``violated`` is true; ``fields`` of them are reported."""

    name: str
    table: str
    violated: str
    fields: Sequence[str]


@dataclass(frozen=True)
class OrphanRule:
    """Rows of ``table`` whose ``keys`` are not among ``parent_keys`` of ``parent``; a null in a key has no parent."""

    name: str
    table: str
    keys: Sequence[str]
    parent: str
    parent_keys: Sequence[str]
    fields: Sequence[str]

    def __post_init__(self):
        if len(self.keys) != len(self.parent_keys):
            raise ValueError(f"rule {self.name}: keys and parent_keys must pair up")


@dataclass(frozen=True)
class UniqueRule:
    """``keys`` that more than one row of ``table`` has, reported with their number ``n``; nulls are equal."""

    name: str
    table: str
    keys: Sequence[str]


@dataclass(frozen=True)
class CompactionSpec:
    """How a dated directory is rewritten into fewer files.

    ``shuffle`` spreads rows evenly over the planned files; without it whole input files are put
    together, which moves no data between executors. None chooses per partition from the sizes of
    the input files. ``bytes_per_file`` plans from file sizes instead of row counts, which saves
    reading the input twice.
    """

    mode: str = "incremental"
    strategy: str = "from_second_latest"
    source_format: str = "json"
    target_format: str | None = None
    schema: StructType | str | None = None
    partition: str = PARTITION_COLUMN
    rows_per_file: int = ROWS_PER_FILE
    tiers: Sequence[tuple[int | None, int]] | None = None
    max_rows_per_file: int = MAX_ROWS_PER_FILE
    bytes_per_file: int | None = None
    shuffle: bool | None = None
    drop: Sequence[str] = ()
    write_options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.mode not in ("full", "incremental"):
            raise ValueError(f"unknown mode {self.mode!r}")


@dataclass(frozen=True)
class IngestSpec:
    """Incremental ingest of rows whose payload column is a JSON string.

    Each run writes a sub-partition ``batch_column`` of its own, so that a repeated run replaces its
    files. None appends plainly instead; a repeated run then doubles its rows. ``set_aside_unkeyed`` has runs after the first
    look through the whole source for rows with a null bookmark key, which no mark covers; without it these rows are not
    looked for, and a run costs what is new.
    """

    job: str
    payload: str
    payload_schema: StructType | str
    bookmark_keys: Sequence[str]
    out: str
    quarantine: str
    partition: str = PARTITION_COLUMN
    partition_value: str | date | None = None
    min_partitions: int | None = None
    files: int | None = None
    batch_column: str | None = "ingest_batch"
    set_aside_unkeyed: bool = True


@dataclass(frozen=True)
class LoadSpec:
    """Raw JSON to relational table."""

    path: str
    schema: StructType | str
    sql: str
    table: str
    payload: str = "PayLoad"
    extract: Mapping[str, str] = field(default_factory=dict)
    params: Mapping[str, object] = field(default_factory=dict)
    max_partitions: int | None = None


@dataclass(frozen=True)
class BatchSpec:
    """Register new partitions, run a query, write its result with another."""

    batch_sql: str
    write_sql: str | None = None
    repair: Sequence[str] = ()
    params: Mapping[str, object] = field(default_factory=dict)
    output: str = "batch_output"


@dataclass(frozen=True)
class AuditStamp:
    """Run identity attached to every audit row; ``at`` is UTC, without a zone."""

    run_id: str
    at: datetime
