"""Training, serving and evaluation data for text-retrieval embedding models, on Spark.

Every operator takes DataFrames and returns a DataFrame; results depend only on the rows, the
parameters and the seed, never on how the rows are partitioned.
"""
