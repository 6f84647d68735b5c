"""Sources, sinks and the model registry."""
