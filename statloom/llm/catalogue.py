"""The registered queries of this subpackage: name -> (Spark query, equivalent SQL or None)."""

from statloom.llm import (exact, fingerprints, lines, mixing, neardup, packing, personal, phrases, secrets, shards,
                          toxicity, urls, whitening)

QUERIES = {}
for module in (packing, fingerprints, toxicity, shards, lines, exact, urls, mixing, neardup, secrets, personal,
               whitening, phrases):
    QUERIES.update(module.QUERIES)
