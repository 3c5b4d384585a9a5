"""Queries: named plans over the tables of a directory."""
