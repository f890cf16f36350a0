"""tessera: a Spark-native toolkit for text statistics, graph analysis and
model fitting (ridge, sparse logistic regression, matrix factorization).

Every operator takes DataFrames and returns DataFrames built from Spark's own
Column expressions, so Catalyst can prune, push down and code-generate the
whole chain.  Iterative operators run a short driver loop that pulls one
scalar per iteration and cuts lineage with reliable checkpoints.
"""

__version__ = "0.1.0"
