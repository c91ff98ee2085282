"""Operators for preparing training text at corpus size; nothing else in the library imports this folder."""
