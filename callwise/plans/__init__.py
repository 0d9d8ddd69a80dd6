"""Whole flows built from the operators, and the queries that the driver checks."""
