"""Orders-and-weather analytics as DataFrame jobs on Spark."""
