"""tripflow: batch and streaming analytics over trip records, on PySpark DataFrames."""
