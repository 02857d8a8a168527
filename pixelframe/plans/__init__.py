"""Estimators, tuning, end-to-end workflows and the query registry."""
