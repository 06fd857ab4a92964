"""Procurement-notice analytics as lazy Spark DataFrame transforms."""
