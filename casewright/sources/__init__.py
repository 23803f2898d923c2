"""Readers, writers and the test-data bindings."""
