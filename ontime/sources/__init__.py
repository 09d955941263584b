"""Reading and cleaning the input files."""
