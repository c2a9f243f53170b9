"""Training-data operators over the tables documents, benchmark, pages,
labels and conversations. Nothing else in the package imports this one.

One module per operator; ``queries`` holds the registered queries and
``oracle`` the DuckDB SQL of those that SQL can express.
"""
