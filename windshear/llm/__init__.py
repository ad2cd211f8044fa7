"""Operators for large-scale training-data pipelines, one module each.

``imatch``       1  document fingerprints (I-Match over randomised lexicon subsets)
``mixing``       2  mixing sources to target weights (entropy balancing, native)
``warc``         3  WARC writing and boundary-chain verified reading
``pii``          4  offset-preserving deobfuscation of personal data
``secrets``      5  random-forest filter over secret candidates (native)
``hyperminhash`` 6  HyperMinHash near-duplicate components
``templates``    7  HTML main text by site template removal
``toxicity``     8  maximum-scoring toxic segments, extreme-value calibrated
``langid``       9  language identification, word first, n-gram backoff
``suffixes``     10 benchmark decontamination by training suffix arrays
``negatives``    11 hard negatives by cover trees over norm-augmented vectors
``transducer``   12 BPE encoding and decoding with bounded lookahead
``alignment``    13 cross-tokenizer pair counts by minimal perfect hashing

``components`` and ``common`` are shared helpers; ``queries`` registers the
thin ``opN_<name>`` queries and their SQL. Nothing outside this subpackage
imports it.
"""
