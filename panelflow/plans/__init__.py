"""Composed loads: D1 usage, D2 snapshot, D3 compliance, D4 run control."""
