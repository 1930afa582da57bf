"""Readers for tables and change logs, writers for results."""
