"""Engagement analytics as plain PySpark DataFrame functions."""
