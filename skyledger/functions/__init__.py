"""Scalar functions: on columns (``columns``) and on the driver (``values``)."""
