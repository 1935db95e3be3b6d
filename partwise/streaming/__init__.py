"""Objects and part results that keep arriving."""
