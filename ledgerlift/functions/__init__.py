"""ledgerlift.functions"""
