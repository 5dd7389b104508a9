from .delimited import records, scan_csv
from .extracts import count_rows, csv_bundle, read_csv_strings, require_inputs, resolve_column, scan_object
from .store import Conflict, TableStore

__all__ = [
    "Conflict", "TableStore", "count_rows", "csv_bundle", "read_csv_strings", "require_inputs", "resolve_column",
    "records", "scan_csv", "scan_object",
]
