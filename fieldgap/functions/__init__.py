"""Column expressions shared by the operators; every function maps Column to Column."""

from fieldgap.functions import aggregates, scalars, text

__all__ = ["aggregates", "scalars", "text"]
