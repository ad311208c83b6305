"""Column functions: text, URLs, HTML, JSON text and time."""
