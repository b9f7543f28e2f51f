"""Dataset transformations: silver, gold, detectors, quality gates."""
