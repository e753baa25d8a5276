"""Whole jobs: silver standardisation, the daily run and the registered queries."""
