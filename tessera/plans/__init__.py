"""Layered tables (cleaned, star schema) and the analytic questions asked of them."""
