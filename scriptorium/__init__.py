"""scriptorium: annotated text corpora and training-data preparation as Spark DataFrames."""
