"""Report tables, hierarchies and end-to-end jobs built from the operators."""
