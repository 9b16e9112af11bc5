"""Slug integrity for product catalogues, as Spark DataFrame operators."""

__version__ = "0.1.0"
