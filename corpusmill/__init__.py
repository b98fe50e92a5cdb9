"""Document-corpus analytics and retrieval on Spark."""
