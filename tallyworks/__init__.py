"""Retail and web-log analytics as reusable Spark DataFrame operators."""
