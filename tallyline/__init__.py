"""Product telemetry analytics as Spark DataFrame operators."""
