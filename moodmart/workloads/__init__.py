"""The warehouse on the generated test tables: stand-in inputs, queries, and the same queries in SQL."""
