"""casewright: case prioritisation on Spark DataFrames, SQL and Spark ML."""
