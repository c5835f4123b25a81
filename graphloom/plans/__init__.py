"""Iterative plans that the operators share."""
