"""Whole dataflows: silver, gold and the analytical queries."""
