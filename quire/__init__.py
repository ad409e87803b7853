"""Quire: document-to-retrieval processing and querying on Spark DataFrames."""
