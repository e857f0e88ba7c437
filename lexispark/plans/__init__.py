"""lexispark.plans"""
