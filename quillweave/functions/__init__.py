"""Column functions: what an expression can say, without a shuffle."""
