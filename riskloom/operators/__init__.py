"""Relational and history operators on transaction tables."""
