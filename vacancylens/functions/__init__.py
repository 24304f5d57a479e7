"""Column expressions: text, dates, links, skills."""
