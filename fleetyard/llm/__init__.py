"""Training-data operators over text corpora (documents, labels, benchmark items).

Nothing else in the library imports this subpackage; ``queries`` registers
one query per operator and ``corpus_pipeline.py`` chains five of them.
"""
