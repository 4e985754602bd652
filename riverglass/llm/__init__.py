"""Training-data operators: ten corpus operators, the queries that apply them, and their SQL."""
