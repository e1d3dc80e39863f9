"""tonality.operators."""
