"""Training-data pipeline operators. Nothing else in the library imports this subpackage.

Each module holds one operator; ``queries`` registers one query per operator.
"""
