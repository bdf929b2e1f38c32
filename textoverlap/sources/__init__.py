"""Readers: parquet tables, folders and lists of text files, lines with positions."""

from textoverlap.sources.documents import read_documents, read_paths, read_table, read_text_files, unreadable_paths
from textoverlap.sources.lines import read_lines, read_numbered_lines

__all__ = ["read_documents", "read_lines", "read_numbered_lines", "read_paths", "read_table", "read_text_files", "unreadable_paths"]
