"""Learning jobs built from the operators."""
