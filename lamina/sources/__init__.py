"""Sources, sinks and table layouts."""
