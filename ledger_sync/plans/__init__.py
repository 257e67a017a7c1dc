"""Warehouse versions and the load of one batch."""
