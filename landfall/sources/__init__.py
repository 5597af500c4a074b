"""Readers: monthly extracts, CSV tables, JSON code maps, and the lake itself."""

from landfall.sources.lake import open_lake
from landfall.sources.readers import (
    monthly_paths,
    read_code_map,
    read_csv,
    read_extract,
    read_extracts,
)

__all__ = [
    "monthly_paths",
    "open_lake",
    "read_code_map",
    "read_csv",
    "read_extract",
    "read_extracts",
]
