"""Column expressions: text, numbers, times, JSON and row predicates."""
