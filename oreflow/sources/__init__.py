"""Readers, writers, schemas and versioned tables."""
