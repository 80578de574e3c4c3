"""The driver tables presented as raw operational tables, and the registered queries."""
