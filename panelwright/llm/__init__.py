"""Operators for preparing training text and vectors; see ``catalog`` for their queries."""
