"""Bindings to the driver's tables, the registered queries and their oracles."""
