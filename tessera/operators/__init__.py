"""Reusable DataFrame operators: dedupe, look-back, spatial, sampling, search, scoring."""
