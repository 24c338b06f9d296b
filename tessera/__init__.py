"""A PySpark-native engine for append-only record stores: resolve, count, rank, draw, measure, group."""
