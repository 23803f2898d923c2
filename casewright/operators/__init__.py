"""Table-level building blocks: DataFrame in, DataFrame out."""
