"""Document retrieval, metadata filtering and table maintenance as Spark jobs."""
