"""Training-data operators: deduplication, language, archives, toxicity, chat text, quality, packing, mixing, search, secrets.

Nothing outside this folder imports it. Each module holds one operator with a
general interface; ``queries`` derives the registered ``opN_`` result tables.
"""
