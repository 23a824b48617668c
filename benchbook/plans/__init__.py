"""Whole runs: loading a batch, reporting on it, and the registered queries."""
