"""Reusable plan shapes."""
