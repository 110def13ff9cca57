"""Operators for preparing training data at scale.

Each module holds one operator; ``queries`` applies them to whole tables. Nothing outside this package
imports it.
"""
