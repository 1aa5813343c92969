"""Scans and sinks: driver tables, the customer-profile table, persistence."""

from segmetric.sources.profile import CATEGORICAL, CP_SQL, LABEL, NUMERIC, customer_profile
from segmetric.sources.tables import (
    TABLES, broadcast_if_bounded, is_bounded, load_processed, read_table, write_json_record, write_table,
)

__all__ = [
    "CATEGORICAL", "CP_SQL", "LABEL", "NUMERIC", "customer_profile", "TABLES", "broadcast_if_bounded",
    "is_bounded", "load_processed", "read_table", "write_json_record", "write_table",
]
