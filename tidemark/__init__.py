"""Prediction-market analytics expressed as Spark DataFrame plans."""
