"""airlens.plans."""
