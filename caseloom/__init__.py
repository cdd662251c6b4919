"""caseloom: surveillance-lakehouse analytics as PySpark DataFrame operators."""
