"""scribeflow."""
