"""Spark-native record cleaning, data quality and text-corpus preparation."""
