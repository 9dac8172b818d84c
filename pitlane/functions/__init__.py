"""Column-level helpers built from pyspark.sql.functions (no Python UDFs)."""
