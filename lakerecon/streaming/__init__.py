from .compact import compact_stream
from .ingest import first_deliveries, ingest_stream
from .stats import corrected_stats_stream, landing_stats_stream, read_corrected_stats

__all__ = [
    "compact_stream",
    "corrected_stats_stream",
    "first_deliveries",
    "ingest_stream",
    "landing_stats_stream",
    "read_corrected_stats",
]
