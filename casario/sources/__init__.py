"""Reading and writing."""

from casario.sources.feeds import folder_table, folder_table_of, parse_lines, read_listings, write_feed
from casario.sources.tables import query_data, replace_partition, save_table

__all__ = [
    "folder_table", "folder_table_of", "parse_lines", "query_data", "read_listings",
    "replace_partition", "save_table", "write_feed",
]
