from gradewise.sources.delimited import export_readable, preview, read_delimited, table_profile
from gradewise.sources.reports import fixed_decimals, metric_report, write_report
from gradewise.sources.scratch import drop_scratch, materialize, scratch_path

__all__ = [
    "drop_scratch",
    "export_readable",
    "fixed_decimals",
    "materialize",
    "metric_report",
    "preview",
    "read_delimited",
    "scratch_path",
    "table_profile",
    "write_report",
]
