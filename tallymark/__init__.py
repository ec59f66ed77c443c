"""Spark-native behaviour-log analytics: rules, features, lookups, evaluation."""
