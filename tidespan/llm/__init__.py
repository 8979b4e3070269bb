"""Operators of a training-data pipeline on documents and conversations. Nothing else in the library imports this."""
