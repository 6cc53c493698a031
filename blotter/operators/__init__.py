"""Table-level operators: classification, summaries, keys, upsert, places,
feed adapters and the model / scoring chain."""
