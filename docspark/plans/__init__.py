"""docspark.plans."""
