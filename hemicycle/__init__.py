"""Legislative-activity analytics on Spark."""
