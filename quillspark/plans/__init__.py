"""Driver loops and the registered query catalog."""
