"""Composite loads built from the operators: daily load, bulk load, flight file load."""
