"""End-to-end programs composed from the operators."""
