"""Operators of panelspark."""
