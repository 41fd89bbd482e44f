"""Document-corpus analytics on Spark: Column and DataFrame builders, no engine of its own."""
