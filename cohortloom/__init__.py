"""Spark-native cohort feature engine: raw health records to model-ready tables."""

__version__ = "0.1.0"
