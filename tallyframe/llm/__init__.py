"""Operators for preparing training data: each module holds one method, ``catalog`` their queries."""
