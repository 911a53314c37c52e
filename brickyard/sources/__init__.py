"""Readers and writers: Parquet/table sources, typed seed CSVs, guarded table
sinks (full refresh and view)."""

from brickyard.sources.io import read_seed, read_source, write_table
from brickyard.sources.seed import SIZE_LABELS, size_labels

__all__ = ["read_seed", "read_source", "write_table", "SIZE_LABELS", "size_labels"]
