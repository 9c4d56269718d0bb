"""airlens.sinks."""
