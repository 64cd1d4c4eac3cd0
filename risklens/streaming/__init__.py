"""Scores of entities that arrive as a stream."""
