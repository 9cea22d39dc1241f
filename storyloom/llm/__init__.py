"""Training-data operators: media, licences, sharding, language, mixing, dedup, toxicity, URLs, pieces.

Nothing outside this folder imports it. Each module holds one operator with a general
interface; ``queries`` derives the registered results from them.
"""
