"""Scans: fixture tables and text files in, typed DataFrames out."""

from tessera.sources.tables import lines_from, load_table, numbers_from, numbers_from_values, points_from
from tessera.sources.text import read_lines, read_numbers, read_points
from tessera.sources.sinks import write_numbers, write_points, write_scored_points

__all__ = [
    "load_table",
    "numbers_from",
    "numbers_from_values",
    "lines_from",
    "points_from",
    "read_numbers",
    "read_lines",
    "read_points",
    "write_numbers",
    "write_points",
    "write_scored_points",
]
