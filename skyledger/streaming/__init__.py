"""Scoring and last-writer-wins resolution of streams of observations."""
