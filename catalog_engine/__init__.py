"""Catalogue cleaning, linking and reporting as lazy Spark DataFrame operators."""
