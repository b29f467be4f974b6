"""Column expressions shared by the operators; plain expressions, without lambdas or Python."""
