"""Composite jobs: silver, gold, quality gate, reconciliation, corrections, layers."""
