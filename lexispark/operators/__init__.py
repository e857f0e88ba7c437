"""lexispark.operators"""
