"""Training-data operators: search, privacy, quality, text extraction, language, tokens,
near copies, chat rendering, sharding and decontamination.

Nothing else in the library imports this subpackage.
"""
