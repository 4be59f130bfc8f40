"""Reading inputs and writing report tables."""
