"""rtmart: a PySpark real-time e-commerce warehouse.

Layers: raw app logs and database change records (ODS) are routed and parsed,
daily-active devices are found and reported, dimensions and user state are kept
by keyed upsert, orders get a first-order flag and a province, and orders are
joined with their line items into a deduplicated wide fact. Batch queries and
Structured Streaming jobs share the same DataFrame functions.
"""

__all__ = ["session"]
