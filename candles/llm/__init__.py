"""Training-data operators: near-duplicates, tokens, archives, filters, classifiers, shards."""
