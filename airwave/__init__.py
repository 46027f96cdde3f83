"""Analytics over repeated snapshots of live video streams, on Spark DataFrames."""
