"""Training-data operators: mixing, neighbour search, fingerprints, list joins, language-model
scoring, line and near-duplicate removal, page extraction, toxicity and packing.

Nothing else in the library imports this subpackage; ``catalog`` holds its registered queries."""
