"""Jobs composed from the operators: bronze, silver, gold, feed generation."""
