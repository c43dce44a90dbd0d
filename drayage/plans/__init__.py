"""Larger plans composed from the operators."""
