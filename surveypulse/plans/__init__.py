"""Whole runs: the status tables of a set of sessions, and the registered queries."""
