"""Training-data operators: filtering, tokens, secrets, packing, search, quality, chat, fingerprints, near copies.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
