"""Spark-native labelling of short texts: cleaning, features, models and scoring."""

__version__ = "0.1.0"
