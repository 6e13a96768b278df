"""plans of the contact engine."""
