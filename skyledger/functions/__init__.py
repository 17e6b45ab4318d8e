"""Column helpers. Everything here is a native expression; there are no UDFs."""
