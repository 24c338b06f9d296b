"""Texts to packed token ids, for byte-level tokenizers whose ids are the ranks of their merges."""

from __future__ import annotations

import json
import os
from array import array
from functools import cached_property

from tessera.llm.words import held

#: Texts beyond so many characters, or with longer runs without a change of class, are left to the reference library.
LONG = 1_000_000


def _alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by rule: printable bytes stand for
    themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """Token bytes to ids of a byte-level JSON file; None if ids aren't the order of merges, so ranks can't stand for them."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    pre, model = told.get("pre_tokenizer") or {}, told.get("model", {})
    if model.get("type", "BPE") != "BPE" or told.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
        return None
    if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    letters, vocab = _alphabet(), model["vocab"]
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(set(merged)) or len(merged) + 256 != len(vocab):
        return None
    return {bytes(letters[c] for c in token): i for token, i in vocab.items()}


class Packed:
    """Little-endian 32-bit ids of texts; special tokens' strings are ordinary text.

    Where ids are the order of merges, the merging by ranks gives the ids that ``tokenizers`` gives, several times as
    fast; other vocabularies, very long texts and what the fast pattern can't take go through ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers

        self.path = path
        ranks = ranks_of(path)
        self.fast = None
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @cached_property
    def tokenizer(self):
        """Loaded where it is needed: it takes more memory than the ranks."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def one(self, text: str) -> bytes:
        ids = None
        if self.fast and len(text) <= LONG:
            try:
                ids = self.fast(text)
            except (ValueError, RuntimeError):  # the pattern's backtracking has a limit
                ids = None
        if ids is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        packed = array("I", ids)
        assert packed.itemsize == 4
        return packed.tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        return [self.one(t) for t in texts]


def packed(path: str) -> Packed:
    return held(f"packed {path}", lambda: Packed(path))
