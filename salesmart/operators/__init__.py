"""Joins, cleaning, keys, and the star tables."""
