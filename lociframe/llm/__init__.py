"""Operators for large training-data pipelines (nothing else imports these)."""
