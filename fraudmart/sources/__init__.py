"""Readers and writers: delimited text, workbooks, INSERT dumps, the Parquet
warehouse, report export, JDBC."""
