"""lakestar: spec-driven lakehouse analytics on the public Spark DataFrame, SQL and Structured Streaming APIs."""
