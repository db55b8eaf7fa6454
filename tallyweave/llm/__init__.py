"""Operators for preparing training text at scale.

Nothing outside this folder imports it. Each module holds one operator with a general
interface (any table, any column names); ``catalog.py`` registers one query per operator.
"""
