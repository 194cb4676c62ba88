"""A retail-sales analytics engine on PySpark: raw files to a cleaned table to a star schema, and its checks."""
