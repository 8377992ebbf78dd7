"""Tidewater: a PySpark-native engine for building training data sets."""
