"""fraudloom: payment-card fraud analytics as Spark DataFrame and Structured Streaming jobs."""
