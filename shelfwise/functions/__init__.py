"""Reusable ``Column`` expressions."""
