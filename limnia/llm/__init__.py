"""Operators for building language-model training data, each by one named method."""
