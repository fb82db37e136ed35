"""Column functions: normalisation, similarity and the fixed word lists."""
