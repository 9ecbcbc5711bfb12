"""Writers of the text formats and of annotated tables."""
