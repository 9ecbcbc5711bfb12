"""Column expressions: identifiers, sequences and scores."""
