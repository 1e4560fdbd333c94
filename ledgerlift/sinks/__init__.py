"""ledgerlift.sinks"""
