"""Corpus preparation for language-model training: ten operators over documents and conversations."""
