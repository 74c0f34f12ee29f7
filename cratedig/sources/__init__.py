"""Where documents come from."""
