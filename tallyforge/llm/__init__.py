"""Operators of a training-data pipeline: texts, web archives and embeddings. Nothing else in the library imports them."""
