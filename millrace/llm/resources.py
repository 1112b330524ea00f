"""Where files outside this repository are found."""

from __future__ import annotations

import os


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """A public tokenizer's file: in ``folder``, in $MILLRACE_TOKENIZERS, or where the ``public_tokenizers`` package has it."""
    folder = folder or os.environ.get("MILLRACE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
