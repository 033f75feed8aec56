"""Whole jobs from documents to results, composed of the operators."""
