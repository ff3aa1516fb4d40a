"""Readers that turn log files into a one-column DataFrame of lines."""
