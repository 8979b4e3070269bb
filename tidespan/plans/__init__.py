"""Queries built from the operators: on the generic tables and the clinical feature pipeline."""
