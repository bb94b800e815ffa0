"""Event schemas, readers and writers."""
