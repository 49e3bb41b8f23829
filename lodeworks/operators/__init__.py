"""Operators, grouped by subject; import the module you need."""
