"""Training-data operators over text corpora (nothing else in the library
imports this subpackage).

common      word/shingle hashing in numpy, staged tables, range groups, components
urls        1  temporal URL list join
secrets     2  secret scan with corpus-wide ownership frequency (native)
bpe         3  BPE with forced-boundary splitting
quality     4  NB-SVM quality classifier
minhash     5  MinHash fingerprints
ngram_join  6  adaptive multi-match prefix Jaccard join
mixing      7  source mixing to target weights
token_files 8  Simple-8b token files
line_rules  9  quality rules and cross-document line frequency (native)
pii         10 PII candidates scored by boosted trees (native)
spans       regex spans as native column expressions (2, 9, 10)
entry       the registered queries and their oracle SQL
"""
