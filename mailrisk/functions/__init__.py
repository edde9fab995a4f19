"""Column expressions: text, labels, links, mail headers and risk levels."""
