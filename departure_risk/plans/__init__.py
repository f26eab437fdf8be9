"""Compositions of operators: feature table, training, scoring, questions, reports."""
