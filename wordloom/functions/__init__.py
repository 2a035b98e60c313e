"""Column expressions: text, HTTP responses, markup, byte codes, output lines."""
