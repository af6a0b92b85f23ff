"""Business queries composed from the operators."""
