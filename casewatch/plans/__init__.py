"""Whole-layer runs built from sources and operators, and the registered queries."""
