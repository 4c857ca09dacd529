"""Functions of the observation engine."""
