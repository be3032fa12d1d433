"""docspark.functions."""
