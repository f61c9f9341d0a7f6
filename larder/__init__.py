"""Grocery order data on Spark: land, clean, check, derive features, recommend."""
