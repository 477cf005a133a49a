"""Whole runs: which operator feeds which."""
