"""Preference-data engine on PySpark: prompt pools, scored candidates, pairs, metrics and checks."""
