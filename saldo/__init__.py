"""Subscription-revenue analytics as Spark DataFrame transformations."""
