"""Record files, and companies derived from the star-schema tables."""
