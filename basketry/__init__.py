"""Basketry: grocery-basket analytics as plain PySpark DataFrame functions."""
