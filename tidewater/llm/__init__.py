"""Training-data operators: deduplication, mixing, tokenising, scoring and extraction of text corpora.

Each module holds one operator with its own interface; ``queries`` registers one thin query
per operator. Nothing outside this package imports it."""
