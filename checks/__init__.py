"""Registered queries: the library run over the given test tables, and their SQL oracles."""
