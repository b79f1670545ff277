"""Continuous versions of the live figures."""
