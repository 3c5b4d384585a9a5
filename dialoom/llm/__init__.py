"""Operators for text meant for language models."""
