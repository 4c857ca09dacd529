"""Sources of the observation engine."""
