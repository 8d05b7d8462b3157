"""Operators for preparing training text: quality, duplicates, rules, tokens, mixing, chats, languages, secrets."""
