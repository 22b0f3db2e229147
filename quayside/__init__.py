"""Freight analytics as Spark DataFrame functions."""
