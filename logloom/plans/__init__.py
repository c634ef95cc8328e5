"""Helpers that shape physical plans: skew, scratch tables, composed pipelines."""
