"""Sources: key listings, raw objects and page texts."""
