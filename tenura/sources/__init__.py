"""Readers, writers and the shared folder for intermediate tables."""
