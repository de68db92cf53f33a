from tidemark.sources.generated import generated_shipments
from tidemark.sources.orders import base_shipments, read_orders
from tidemark.sources.tables import scan_date, scan_window, shipments

__all__ = [
    "base_shipments",
    "generated_shipments",
    "read_orders",
    "scan_date",
    "scan_window",
    "shipments",
]
