"""DataFrame -> DataFrame operators, grouped as in the survey inventory."""
