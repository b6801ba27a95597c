"""A PySpark-native engine for profiling, validating and synchronizing knowledge graphs."""
