from rainloom.sources.readers import (
    jdbc_options, read_csv, read_json, read_metrics, read_observations, read_raw_text, read_series, read_table,
)
from rainloom.sources.tables import append_raw, normalize_columns, read_import_log, read_raw_table, with_audit_columns
from rainloom.sources.writers import (
    append_metrics, write_predictions, write_report, write_splits,
)

__all__ = [
    "append_metrics", "append_raw", "jdbc_options", "normalize_columns", "read_csv", "read_import_log", "read_json",
    "read_metrics", "read_observations", "read_raw_table", "read_raw_text", "read_series", "read_table",
    "with_audit_columns", "write_predictions", "write_report", "write_splits",
]
