"""Whole jobs made of the operators, with their command lines."""
