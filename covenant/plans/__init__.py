"""covenant.plans"""
