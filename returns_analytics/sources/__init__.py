"""Reading the input tables and writing the output tables."""
