"""Speech-label analytics on Spark."""
