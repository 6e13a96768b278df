"""functions of the contact engine."""
