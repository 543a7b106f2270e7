"""millrace: batch analytics jobs on PySpark DataFrames."""
