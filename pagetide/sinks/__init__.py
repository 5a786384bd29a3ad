"""Exports, reports and landed pages. Every sink writes in parallel; none collects rows."""
