"""Relational operators: reconcile, keys, run control, load gates."""
