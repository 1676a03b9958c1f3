"""Training-data operators: quality, language, duplicates, licences, secrets, tokens, packing, media."""
