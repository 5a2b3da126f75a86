"""Sources, sinks and table adapters."""
