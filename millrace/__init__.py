"""Factory telemetry analytics written as Spark DataFrame and Structured Streaming jobs."""
