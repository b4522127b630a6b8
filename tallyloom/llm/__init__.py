"""Training-data operators: filters, deduplication, media, tokenisation and mixing."""
