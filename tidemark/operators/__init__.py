"""Operators on shipment frames and tables; import them from their modules."""
