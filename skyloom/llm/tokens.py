"""Token ids of a byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import json

import numpy as np


def vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """Paths of the vocabulary in the form that tokenizers reads and, as ranks, in the form that tiktoken reads."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


_open: dict[tuple[str, str | None], "Encoder"] = {}


class Encoder:
    """Ids as tokenizers gives them with ``add_special_tokens=False``.

    Where ``ranks_path`` has the same vocabulary as ranks, texts are encoded by tiktoken, which gives the same ids
    about five times as fast; a text that holds a special token's string goes to tokenizers.
    """

    def __init__(self, json_path: str, ranks_path: str | None = None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(json_path)
        with open(json_path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        self.fast = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def get(cls, json_path: str, ranks_path: str | None = None) -> "Encoder":
        key = (json_path, ranks_path)
        if key not in _open:
            _open[key] = cls(*key)
        return _open[key]

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())
