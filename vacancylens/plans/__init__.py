"""Composed plans: stage chains, test-table views, the query catalog."""
