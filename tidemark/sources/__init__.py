"""Readers.  Every reader takes an explicit schema."""
