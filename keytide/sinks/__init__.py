"""Where logs go."""
