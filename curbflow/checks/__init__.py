"""Registered queries over the derived fleet tables, and the same results in plain SQL."""
