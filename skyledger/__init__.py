"""Spark-native scoring of versioned observation archives."""
