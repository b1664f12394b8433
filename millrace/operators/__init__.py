"""Bounded forms of the operators; most also accept streaming tables."""
