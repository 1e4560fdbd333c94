"""ledgerlift.streaming"""
