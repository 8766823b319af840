"""Column functions and radiometric models."""
