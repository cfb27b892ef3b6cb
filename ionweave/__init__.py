"""Spark-native targeted LC-MS/MS analytics."""
