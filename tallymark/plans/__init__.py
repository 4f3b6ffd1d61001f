"""Whole runs: export the profiles of many tables, reconcile many copies."""
