"""Readers, writers and schema mapping."""
