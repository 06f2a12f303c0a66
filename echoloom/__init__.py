"""App-review analytics written as PySpark DataFrame jobs."""
