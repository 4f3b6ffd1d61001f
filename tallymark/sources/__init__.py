"""Readers of tables, copies, control files and logs."""
