"""Skeinworks: concept graphs, similarity and set operators as plain PySpark DataFrame functions."""
