"""Lead-table analytics on Spark: columns, operators and jobs over DataFrames and streams."""
