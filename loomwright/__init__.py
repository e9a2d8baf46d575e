"""Text curation, evidence retrieval and export for training corpora, on Spark DataFrames."""
