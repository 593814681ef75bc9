"""Operators: pure DataFrame to DataFrame functions that trigger no action."""
