"""Registered queries over the generated benchmark tables, and the same queries as SQL text."""
