"""Training-data operators: ten building blocks for a language-model corpus pipeline.

Nothing outside this subpackage imports it.
"""
