"""Spark-first operators for perioperative vital-sign, laboratory and patient data."""
