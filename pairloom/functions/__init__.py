"""Column expressions: hashing draws, vector maths, text rules."""
