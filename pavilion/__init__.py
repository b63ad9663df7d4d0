"""Sports-statistics lakehouse jobs and operators on PySpark DataFrames."""
