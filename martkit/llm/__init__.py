"""Training-data operators: packing, scoring, filtering, joining and fingerprinting of text corpora.

One module per operator; ``queries`` registers one ``opN_<name>`` query each.  Nothing outside this
subpackage imports it.
"""
