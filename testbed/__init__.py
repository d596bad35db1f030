"""Queries over the driver's test tables and the SQL they are checked against."""
