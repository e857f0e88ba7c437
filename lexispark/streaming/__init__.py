"""lexispark.streaming"""
