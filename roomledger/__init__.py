"""Listing analytics on PySpark: extraction, standardisation, keyed history and reports."""
