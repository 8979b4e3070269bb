"""Reusable DataFrame operators. None of them collects, caches or needs a Python UDF."""
