"""Readers: tables, files and databases."""
