"""Sources and sinks: parquet tables, CSV files, text (DOT) output, event streams."""
from airnet.sources.csv import STATION_SCHEMA, ingest, read_raw_csv, read_table_csv  # noqa: F401
from airnet.sources.wide_csv import header_table, read_wide_csv, wide_csv_to_long  # noqa: F401
from airnet.sources.tables import load_table  # noqa: F401
