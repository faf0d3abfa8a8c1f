"""Operators for cleaning, selecting and packing training text."""
