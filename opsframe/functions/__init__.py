"""Column-level helpers: predicates, times, item mapping and row rules."""
