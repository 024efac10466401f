"""quotebook: one clean price book from several overlapping listing sources, on Spark."""
