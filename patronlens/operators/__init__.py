"""Operators over orders, customers and scores."""
