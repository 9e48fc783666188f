"""Readers, writers and generators."""
