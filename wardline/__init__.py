"""Hospital records, billing and scheduling analytics as Spark DataFrame operators."""
