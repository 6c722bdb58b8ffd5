"""Document-to-retrieval analytics on PySpark."""
