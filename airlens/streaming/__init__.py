"""airlens.streaming."""
