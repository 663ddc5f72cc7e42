"""Windowed metrics over a stream of trips."""
