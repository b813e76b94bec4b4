"""Registered queries over the test tables, each beside SQL that computes the same."""
