"""Spark-native commerce and event analytics: operators from DataFrames to DataFrames."""
