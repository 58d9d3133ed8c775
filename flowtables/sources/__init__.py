"""Reading and writing flows."""
