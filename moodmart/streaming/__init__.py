"""The article refresh over pages as they land."""
