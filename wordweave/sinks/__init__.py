"""Writers."""

from wordweave.sinks.corpus import write_packed_documents, write_text_folders
from wordweave.sinks.observed import metric_rows, write_index, write_line_sets
from wordweave.sinks.replace import replacing
from wordweave.sinks.text import write_delimited, write_metrics, write_pairs, write_report

__all__ = [
    "metric_rows",
    "replacing",
    "write_delimited",
    "write_index",
    "write_line_sets",
    "write_metrics",
    "write_packed_documents",
    "write_pairs",
    "write_report",
    "write_text_folders",
]
