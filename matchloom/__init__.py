"""Short-text matching and ranked retrieval as Spark DataFrame operators."""
