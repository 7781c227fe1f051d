"""Composite plans: the reporting bundle (W1) and the whole pipeline."""
