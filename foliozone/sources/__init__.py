"""Source adapters, captured hand-off files and the stored zones."""
