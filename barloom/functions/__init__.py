"""Column expressions shared by the operators; all of them are compositions of built-ins."""
