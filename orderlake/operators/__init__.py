"""Relational operators and the star-schema model."""
