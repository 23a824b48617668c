"""Spark-native engine that turns court-judgment text into a clean, queryable table."""
