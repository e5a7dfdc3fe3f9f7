"""Column functions: text, n-grams and similarities."""
