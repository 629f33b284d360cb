"""Relational building blocks of the sync plan."""
