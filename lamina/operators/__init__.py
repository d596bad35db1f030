"""DataFrame operators for layered warehouse work."""
