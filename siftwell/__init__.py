"""Spark-native analytics over security-scanner findings."""
