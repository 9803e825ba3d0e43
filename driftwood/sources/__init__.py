"""Readers, landers and parsers."""
