"""Readers for raw, bronze and published data, and their contracts."""
