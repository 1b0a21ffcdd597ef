"""DataFrame operators, by topic."""
