"""covenant.sources"""
