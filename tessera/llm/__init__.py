"""Operators and queries for training-data preparation (ten operators and a
corpus pipeline).  Nothing else in the library imports this subpackage."""
