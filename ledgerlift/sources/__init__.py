"""ledgerlift.sources"""
