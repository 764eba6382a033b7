"""Training-data operators: quality, fingerprints, URL rules, toxicity, WARC, BPE, mixing, top-k, language, SimHash.

Nothing outside this subpackage imports it. The registered queries are in ``queries``.
"""
