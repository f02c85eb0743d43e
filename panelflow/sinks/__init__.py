"""Sinks: append, full refresh, insert-new-keys, per-date replace, update, run log."""
