"""airlens.sources."""
