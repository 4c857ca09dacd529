"""Operators of the observation engine."""
