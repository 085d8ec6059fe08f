"""Reading payloads and tables, writing versioned tables, exporting results."""
