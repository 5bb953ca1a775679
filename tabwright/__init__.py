"""Spark-native preparation of wide business tables for classification."""
