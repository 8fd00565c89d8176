from .audit import append_audit, repair_table
from .files import export_missing, quarantine, write_history, write_raw
from .jdbc import load_jdbc, reload_jdbc, verify_load, write_options

__all__ = [
    "append_audit",
    "export_missing",
    "load_jdbc",
    "quarantine",
    "reload_jdbc",
    "repair_table",
    "verify_load",
    "write_history",
    "write_options",
    "write_raw",
]
