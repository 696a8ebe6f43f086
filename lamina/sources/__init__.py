"""Readers of raw and staged files."""
