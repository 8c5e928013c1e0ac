"""Specs (chains of operators with arguments) and their compilation into DataFrames."""
