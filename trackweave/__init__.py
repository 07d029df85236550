"""Track analytics as DataFrame operators on Spark."""
