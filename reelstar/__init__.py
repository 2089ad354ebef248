"""Spark-native movie/user analytics: feeds, star schema, queries, checks."""
