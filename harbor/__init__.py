"""A PySpark engine for archives of received vessel-tracking (AIS) sentences."""
