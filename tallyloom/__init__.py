"""Spark-native analytics over catalogs of segmented, scored recordings."""
