"""tonality.functions."""
