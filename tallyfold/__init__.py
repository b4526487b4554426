"""Cloud cost and usage analytics as PySpark DataFrame operations."""
