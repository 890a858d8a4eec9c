"""Spark-native analytics: data quality, joins, ranking, grids, geography, star schemas."""
