"""Spark-native processing of health-plan network submissions and standards."""
