"""Lookup joins, rules, table builders and profiles, as functions from DataFrame to DataFrame."""
