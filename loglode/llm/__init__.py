"""Operators that turn crawled documents into training data."""
