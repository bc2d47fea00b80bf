"""Training-data operators: language-model scores, duplicates, tokens, packing, archives, toxicity, search."""
