"""Whole runs: transformation, validation and monitoring."""
