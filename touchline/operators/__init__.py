"""Operators over visits and touches; each returns a lazy DataFrame."""
