"""Models and queries composed from the operators."""
