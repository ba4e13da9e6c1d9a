"""Readers, writers and the tables the library keeps between runs."""
