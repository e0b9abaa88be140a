"""Spark-native profiling, change-history features and leakage-aware model evaluation."""
