"""Readers and writers of landed pages and layer tables."""
