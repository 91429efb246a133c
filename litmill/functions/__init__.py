"""Column expressions and vectorised helpers shared by the operators."""
