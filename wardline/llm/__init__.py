"""Operators for preparing training text: filtering, deduplication, decontamination, tokens and chat."""
