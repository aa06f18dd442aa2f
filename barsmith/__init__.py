"""Bar analytics on Spark: DataFrame-to-DataFrame operators for intraday price bars."""
