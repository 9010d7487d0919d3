"""Reading inputs and appending results."""
