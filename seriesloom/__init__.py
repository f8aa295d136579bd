"""Daily-series, text-score and class-table analytics on Spark DataFrames."""
