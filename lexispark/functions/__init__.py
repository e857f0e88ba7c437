"""lexispark.functions"""
