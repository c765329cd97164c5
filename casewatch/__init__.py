"""Drug-safety report analytics expressed as Spark DataFrame operations."""
