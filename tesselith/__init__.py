"""Spark-native analytics over slide patch plans, masks, rasters and records."""
