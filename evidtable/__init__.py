"""Spark-native engine that turns semi-structured documents into auditable measurement tables."""
