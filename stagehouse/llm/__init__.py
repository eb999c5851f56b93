"""Operators for training-data corpora, their queries and the SQL they must agree with."""
