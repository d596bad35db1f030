"""Layered employee-risk warehouse on Spark: raw tables, detail layer, marts."""
