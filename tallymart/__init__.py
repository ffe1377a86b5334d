"""Governed retail metrics as plain PySpark DataFrame jobs."""
