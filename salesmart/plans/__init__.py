"""Whole jobs: load snapshots, export cleaned entities, build the star."""
