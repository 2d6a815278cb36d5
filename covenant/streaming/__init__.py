"""covenant.streaming"""
