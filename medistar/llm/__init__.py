"""Training-data operators: packing, nearest neighbours, exact top-k, mixing,
HTML extraction, substring / line / near-duplicate removal, toxicity, secrets.

Nothing outside this folder (but the guarded hook of the registry) imports it.
"""
