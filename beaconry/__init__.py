"""Customer analytics on Spark: metric layer, features, series, text, search."""
