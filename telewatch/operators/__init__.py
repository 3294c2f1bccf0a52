"""telewatch.operators"""
