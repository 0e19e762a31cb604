"""Training-data operators: sharding, de-duplication, quality, links, tokens, secrets, archives."""
