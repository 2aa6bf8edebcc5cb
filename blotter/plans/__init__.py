"""The four analyses, each from typed tables to a result table."""
