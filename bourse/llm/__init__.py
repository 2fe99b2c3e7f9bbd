"""Training-data operators: ten corpus operators and the queries that apply
them to the tables ``documents embeddings pages labels conversations``.

Nothing else in the library imports this package.
"""
