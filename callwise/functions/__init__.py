"""Column expressions and the distributed ranking primitives the operators share."""
