"""Readers and writers of episode datasets, and frames from the driver tables."""
