"""Data-estate hygiene on Spark: find unused data, plan its safe removal, report on it."""
