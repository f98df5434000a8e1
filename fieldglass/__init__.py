"""Sports-analytics operators for Spark: DataFrame in, DataFrame out."""
