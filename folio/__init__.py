"""Spark-native document sections, person names and name correction."""
