"""Recommender data preparation, modelling and evaluation as Spark jobs."""
