"""Column functions: token classification, formatting, dates."""
