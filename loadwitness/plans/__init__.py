"""Whole answers: validation suite, verdicts, reports."""
