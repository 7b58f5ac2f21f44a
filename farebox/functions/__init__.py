"""farebox."""
