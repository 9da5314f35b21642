"""Transaction and fraud analytics as plain PySpark DataFrame operators and jobs."""
