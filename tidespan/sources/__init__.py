"""Source registry, schema contracts, sinks."""
