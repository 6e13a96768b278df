"""streaming of the contact engine."""
