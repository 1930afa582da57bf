"""Registered queries: every operator run over the given tables.

Each entry pairs a Spark query with the SQL that has to give the same rows.
"""

from importlib import import_module


def load():
    """``(queries, sql)`` of every module in this package."""
    from twinledger.queries.registry import ORACLES, QUERIES

    for module in ("diff_queries", "audit_queries", "log_queries", "report_queries", "capture_queries"):
        import_module(f"{__name__}.{module}")
    return QUERIES, ORACLES
