"""Customer-churn medallion tables and data-quality checks as Spark DataFrames."""
