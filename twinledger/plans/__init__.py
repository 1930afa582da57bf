"""Whole procedures: compare a set of tables, decide on and run a replay."""
