"""Cell tables arriving as files."""
