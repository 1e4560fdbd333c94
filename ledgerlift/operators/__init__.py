"""ledgerlift.operators"""
