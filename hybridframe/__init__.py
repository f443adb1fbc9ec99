"""Document, vector and hybrid search over collections of records, as PySpark DataFrame operators."""
