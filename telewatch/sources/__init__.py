"""telewatch.sources"""
