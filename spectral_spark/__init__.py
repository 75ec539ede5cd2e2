"""Spark jobs for the survey-scale data work of a fibre-spectrograph reduction."""
