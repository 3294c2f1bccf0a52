"""telewatch.plans"""
