"""Document-corpus analytics expressed as PySpark DataFrame plans."""
