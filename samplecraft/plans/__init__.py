"""Physical strategies shared by the operators."""
