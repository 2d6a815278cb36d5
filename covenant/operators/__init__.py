"""covenant.operators"""
