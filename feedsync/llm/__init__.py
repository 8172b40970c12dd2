"""Operators of a training-data pipeline (packing, de-duplication, search, chat, WARC).

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
