"""Whole runs (training, batch scoring) and the catalogue of named queries with their SQL."""
