"""docspark.sources."""
