"""Training-data operators. Nothing outside this package, ``corpus_pipeline.py`` and their tests imports it."""
