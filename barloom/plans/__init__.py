"""Whole jobs: the layer refresh, snapshot comparison, serving and reconciliation queries."""
