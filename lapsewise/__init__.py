"""Retention analytics as Spark DataFrame plans."""
