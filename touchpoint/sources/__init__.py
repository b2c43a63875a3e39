"""Readers."""
