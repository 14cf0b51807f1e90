"""Scans of the source tables, the calendar, delimited files and table loads."""
