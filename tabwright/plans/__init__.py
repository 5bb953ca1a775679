"""Operators put together: raw table to base table to model input."""
