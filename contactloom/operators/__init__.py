"""operators of the contact engine."""
