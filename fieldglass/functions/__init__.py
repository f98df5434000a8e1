"""Column functions: classifiers, units, names, similarity."""
