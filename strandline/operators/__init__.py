"""DataFrame operators of the archive."""
