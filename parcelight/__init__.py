"""Spark-native analytics for object detections in aerial imagery."""
