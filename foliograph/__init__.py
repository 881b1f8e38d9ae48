"""Document-to-graph analytics on Spark."""
