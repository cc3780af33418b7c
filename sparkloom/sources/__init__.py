"""Readers and writers."""

from .readers import read_category_json, read_dictionary_json, read_log_lines, read_nested_json, read_seeds, read_text_csv
from .writers import write_by_entity, write_csv, write_csv_per_column, write_json, write_markdown_report, write_name_list
from .xlsx import XlsxDataSource, register_xlsx

__all__ = [
    "XlsxDataSource", "read_category_json", "read_dictionary_json", "read_log_lines", "read_nested_json", "read_seeds", "read_text_csv", "register_xlsx",
    "write_by_entity", "write_csv", "write_csv_per_column", "write_json", "write_markdown_report", "write_name_list",
]
