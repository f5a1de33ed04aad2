"""folioframe: document structure analytics on PySpark DataFrames."""
