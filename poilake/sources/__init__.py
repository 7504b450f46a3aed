"""Readers, writers, normalisers and table maintenance."""
