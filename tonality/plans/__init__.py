"""tonality.plans."""
