"""tidespan: per-stay, time-binned feature tables built with Spark DataFrames."""
