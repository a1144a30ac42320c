"""Readers, writers, vocabularies and keyed tables."""
