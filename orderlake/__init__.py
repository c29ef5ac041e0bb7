"""orderlake — a Spark-native order-analytics engine.

Raw order events (CSV, JSON lines or an event log) are ingested into an
append-only bronze table, modelled into a star schema (five dimensions and
one order-grain fact), checked, published by snapshot swap and reported on.
Every stage is a DataFrame / Spark SQL / Structured Streaming plan; nothing
passes whole through the driver.
"""

__version__ = "0.1.0"
