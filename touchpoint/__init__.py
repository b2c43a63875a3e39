"""Spark jobs and operators for customer-touchpoint data."""
