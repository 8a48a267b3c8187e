"""Operators: plain DataFrame functions over logs and tables."""
