"""Column builders: vector arithmetic, text preparation, JSON predicates."""
