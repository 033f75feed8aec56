"""Readers."""

from wordweave.sources.corpus import (
    documents_table,
    numbered_text_lines,
    packed_documents,
    text_documents,
    text_lines_by_file,
    text_lines_by_folder,
)
from wordweave.sources.delimited import cleaned_lines, stop_word_list, word_counts

__all__ = [
    "cleaned_lines",
    "documents_table",
    "numbered_text_lines",
    "packed_documents",
    "stop_word_list",
    "text_documents",
    "text_lines_by_file",
    "text_lines_by_folder",
    "word_counts",
]
