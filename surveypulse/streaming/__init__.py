"""Facts of event logs as they arrive."""
