"""Column expressions and message codecs."""
