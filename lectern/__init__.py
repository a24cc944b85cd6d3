"""Staffing and attention analytics on Spark, with operators for large document sets."""
