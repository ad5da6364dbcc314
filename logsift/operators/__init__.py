"""Lazy DataFrame -> DataFrame operators: location join, analytics, detectors."""
