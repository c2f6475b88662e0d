"""Sensor time-series quality on Spark: clean, audit, summarise and flag device readings."""
