"""Scans of target lists, page reports, landed pages and foreign snapshots."""
