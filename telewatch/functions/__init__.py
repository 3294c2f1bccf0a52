"""telewatch.functions"""
