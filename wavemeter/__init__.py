"""Network-performance analytics as PySpark DataFrame operators."""
