"""Reading extracts."""
