from daybook.sinks.csv import output_names, write_csv, write_small_csv
from daybook.sinks.report import daily_report, overview_report, sample_rows, schema_profile, to_pandas

__all__ = [
    "daily_report",
    "output_names",
    "overview_report",
    "sample_rows",
    "schema_profile",
    "to_pandas",
    "write_csv",
    "write_small_csv",
]
