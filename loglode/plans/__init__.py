"""Whole plans built from the operators: the ingest pipeline and the panels."""
