"""Operators for preparing training text: quality, copies, personal data, mixing, tokens, chat, shards, pages."""
