"""tonality.sources."""
