"""Column functions: JSON coercion, event hours, text slices and predicates."""
