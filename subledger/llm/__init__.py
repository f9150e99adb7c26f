"""Training-data operators: extraction, dedup, decontamination, tokenisation, archives.

Nothing outside this package imports it; ``queries.py`` holds the thin queries
and their SQL, ``corpus_pipeline.py`` at the repository top strings five of the
operators together.
"""
