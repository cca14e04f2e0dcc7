"""Operators of a training-data pipeline: ten methods, each in a module of its own."""
