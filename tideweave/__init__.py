"""Spark-first operators that turn audit logs into validated temporal networks."""
