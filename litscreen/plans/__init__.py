"""Whole jobs, and the contract queries with their SQL."""
