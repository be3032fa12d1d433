"""docspark.streaming."""
