"""Training-data operators: thirteen document, page, URL and vector operators and their queries.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
