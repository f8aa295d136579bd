"""Readers with fixed schemas and the stored-table helpers."""
