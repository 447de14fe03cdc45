"""Complete runs and the checked queries."""
