"""Training-data operators: tokenizing, mixing, sharding, quality and toxicity
scores, similarity joins, vector search, personal data, token attribution.

Nothing else in the library imports this subpackage; ``registry`` holds its
queries and their SQL.
"""
