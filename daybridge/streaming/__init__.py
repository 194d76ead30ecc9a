"""Micro-batch trigger for the daily load."""
