"""Training-data operators: PII, quality rules, BPE, language ID, n-gram
Jaccard join, WARC, source mixing, nearest neighbours, LM scoring, toxicity."""
