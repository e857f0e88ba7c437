"""lexispark.sources"""
