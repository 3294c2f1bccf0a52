"""telewatch.streaming"""
