"""sources of the contact engine."""
