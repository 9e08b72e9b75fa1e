"""affinity: text, similarity, recommendation, graph, clustering and search
operators, each a function from DataFrames to a DataFrame."""
