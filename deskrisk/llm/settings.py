"""Production parameters that queries and pipeline share."""

from __future__ import annotations


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pattern that splits text before merging."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
