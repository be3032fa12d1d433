"""docspark.operators."""
