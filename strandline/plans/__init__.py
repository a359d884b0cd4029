"""Queries over the test tables, planning and control."""
