"""Reading raw lines and side files, choosing input files, and writing tables."""
