"""Column helpers; every one is an expression over built-in functions."""
