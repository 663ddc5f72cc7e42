"""Whole jobs: batch layers, stream, export."""
