"""Review-sentiment analytics expressed as PySpark DataFrame operators."""
