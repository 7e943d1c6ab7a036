"""Publishing a settled series."""
