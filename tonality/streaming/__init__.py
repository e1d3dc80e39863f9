"""tonality.streaming."""
