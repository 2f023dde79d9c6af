"""Column expressions. All of them stay inside generated code, except the Arrow UDFs in ``people``."""
