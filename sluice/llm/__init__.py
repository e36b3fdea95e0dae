"""Training-data operators: near-duplicate joins, quality rules, extraction,
personal data, tokenisation, fingerprints, chat formatting, line de-dup,
secret scans and packing. Nothing else in the library imports this package."""
