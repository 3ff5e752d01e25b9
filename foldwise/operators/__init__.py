"""Operators: fit -> small lookup state -> transform by expression or join."""
