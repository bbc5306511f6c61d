from opinara.sources.readers import (
    load_model,
    read_comments,
    read_labels,
    read_submissions,
    read_table,
)
from opinara.sources.writers import save_model, write_json_lines, write_report_csv, write_table

__all__ = [
    "load_model",
    "read_comments",
    "read_labels",
    "read_submissions",
    "read_table",
    "save_model",
    "write_json_lines",
    "write_report_csv",
    "write_table",
]
