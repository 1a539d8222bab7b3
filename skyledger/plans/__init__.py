"""Whole runs: request, plan, execution, manifest."""
