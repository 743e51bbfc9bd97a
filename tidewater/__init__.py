"""A Spark-native engine for guarded lakehouse tables: typing, contracts, drift, history, watermarks and star-schema models."""
