"""Readers and writers."""

from velograph.sources.edges import malformed_edges, read_edges, read_edges_strict, rejected_edges
from velograph.sources.listings import LINE_ORDER, rank_listing_lines, read_listing, row_listing, write_listing
from velograph.sources.tables import read_table
from velograph.sources.trips import malformed_trips, read_trips

__all__ = [
    "LINE_ORDER",
    "malformed_edges",
    "malformed_trips",
    "rank_listing_lines",
    "read_edges",
    "read_edges_strict",
    "read_listing",
    "read_table",
    "read_trips",
    "rejected_edges",
    "row_listing",
    "write_listing",
]
