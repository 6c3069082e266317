"""Tamis: a Spark-native engine for curating text and chat corpora."""
