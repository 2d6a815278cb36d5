"""covenant.functions"""
