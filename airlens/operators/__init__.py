"""airlens.operators."""
