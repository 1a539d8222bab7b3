"""Data sources and sinks: ``observations`` (archives) and ``predictions``."""
