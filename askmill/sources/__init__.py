"""Readers: delimited files, Parquet, tables, JSON payloads, landed pages and literals."""

from askmill.sources.api import api_rows, read_api_pages
from askmill.sources.csv import read_csv, read_csv_files, split_rejects, unread_files
from askmill.sources.headed import read_headed, stream_headed
from askmill.sources.landed import LandedPages, land_pages, landed_pages
from askmill.sources.literals import BASE_TOPICS, base_topics, flatten_structs, rows_to_frame
from askmill.sources.maps import map_entries, read_map_file
from askmill.sources.tables import query_frame, read_pages, read_parquet, read_table

__all__ = [
    "BASE_TOPICS",
    "LandedPages",
    "api_rows",
    "base_topics",
    "flatten_structs",
    "land_pages",
    "landed_pages",
    "map_entries",
    "query_frame",
    "read_api_pages",
    "read_csv",
    "read_csv_files",
    "read_headed",
    "read_map_file",
    "read_pages",
    "read_parquet",
    "read_table",
    "rows_to_frame",
    "split_rejects",
    "stream_headed",
    "unread_files",
]
