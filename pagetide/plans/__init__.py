"""Whole jobs: tables on disk, loading, daily work, and the registered queries."""
