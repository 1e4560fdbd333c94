"""ledgerlift.plans"""
