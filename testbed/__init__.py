"""Participant, cohort and measure tables derived from the star-schema test tables."""
