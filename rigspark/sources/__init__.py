"""Readers and writers of capture tables."""
