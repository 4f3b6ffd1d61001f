"""Reconciliation of offloaded tables, written as Spark DataFrame jobs.

``tallymark`` checks that a table copied out of a warehouse still holds the
same data: it profiles both sides, compares the profiles, classifies every
table and logs the outcome. It also digests rows, so that the rows that differ
can be found.
"""
