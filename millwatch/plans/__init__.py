"""Whole jobs built from the operators, and the catalog of runnable queries."""
