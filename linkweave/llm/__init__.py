"""Operators for preparing the training data of language models. Nothing outside imports them."""
