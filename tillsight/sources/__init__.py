"""Readers, table roles and writers."""
