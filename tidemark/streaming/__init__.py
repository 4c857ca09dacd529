"""Streaming of the observation engine."""
