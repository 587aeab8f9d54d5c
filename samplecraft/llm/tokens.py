"""Token ids of whole texts by a public tokenizer.

Every text is handed whole to the tokenizers library, in slices of bounded size, and its
ids come back as flat arrays with bounds. The characters that a token covers come from
the library too; of a byte-level tokenizer, whose tokens are exactly the text's bytes one
after the other, they follow from the tokens' lengths, so that the library need not list
them.

Some rules of a tokenizer's file change nothing in a plain text, one of printable ASCII,
spaces, tabs and line ends: composing characters, making white space one space before it
is dropped, and writing bytes as letters. Whole plain texts go to the same tokenizer
without these rules, which gives the same ids sooner; all other texts to the file's own.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from . import words as W

WORD_TOKENIZER = "word_bpe_49k.json"
SLICE = 1_000_000  # characters or bytes encoded at once, unless one text is longer

_PLAIN = re.compile(r"[\t\n\r -~]*").fullmatch
_LOWERCASE = {"type": "Lowercase"}
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, _LOWERCASE]
_SPLIT = {  # into pieces that hold no white space
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def tokenizer_file(name: str) -> str:
    """Where a tokenizer's file lies on this machine; ``name`` may be a path already."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _byte_level(path: str) -> bool:
    """Whether a text's tokens are its bytes, none added and none left out."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    before = rules.get("pre_tokenizer") or {}
    plain = not any(t.get("lstrip") or t.get("rstrip") for t in rules.get("added_tokens", []))
    return plain and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and rules.get("normalizer") is None


def _rules_for_plain(path: str) -> str | None:
    """The rules that a plain text needs, as JSON: the file's without NFC, which keeps
    ASCII, without the change of white space, which no piece holds, and without the byte
    letters, which for these characters are themselves. None if the file has other rules."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    known = rules.get("normalizer") == {"type": "Sequence", "normalizers": _NORMALIZERS}
    known &= rules.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}
    if not known or any(t.get(k) for t in rules.get("added_tokens", []) for k in ("normalized", "lstrip", "rstrip")):
        return None
    return json.dumps(rules | {"normalizer": _LOWERCASE, "pre_tokenizer": _SPLIT})


class Encoder:
    """Tokens of texts as flat arrays with bounds."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = tokenizer_file(name)
        self.tokenizer = Tokenizer.from_file(path)
        rules = _rules_for_plain(path)
        self.plain = Tokenizer.from_str(rules) if rules else None  # same ids for plain texts
        self.sizes = None  # bytes of each token of a byte-level tokenizer
        if _byte_level(path):
            self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self.sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]  # a character stands for a byte
            for i, added in self.tokenizer.get_added_tokens_decoder().items():
                self.sizes[i] = len(added.content.encode())

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin, plus the end. Null is empty."""
        found, sizes = [], []
        for one in self._encodings(texts, self._without_offsets):
            found.append(one.ids)
            sizes.append(len(found[-1]))
        ids = np.fromiter(chain.from_iterable(found), np.int32, sum(sizes))
        return ids, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def spans(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First character and the one after the last of all tokens, counted from the
        first text's start through all texts, and where each text's tokens and its
        characters begin, plus the end. A token of a part of a character covers it all."""
        data, bounds = W.text_bytes(texts)
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters that begin in front of each byte
        begins = before[bounds]
        if self.sizes is not None:
            ids, at = self.ids(texts)
            ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])
            if (ends[at] == bounds).all():
                return before[ends[:-1] + 1] - 1, before[ends[1:]], at, begins
        found, sizes = [np.zeros((0, 2), np.int64)], []
        for one in self._encodings(texts, self.tokenizer.encode_batch):
            found.append(np.array(one.offsets, np.int64).reshape(-1, 2) + begins[len(sizes)])
            sizes.append(len(found[-1]))
        spans = np.concatenate(found)
        return spans[:, 0], spans[:, 1], np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), begins

    def _without_offsets(self, texts: list[str], **options) -> Iterator:
        plain = [self.plain is not None and _PLAIN(t) is not None for t in texts]
        found = {}
        for kind, tokenizer in ((True, self.plain), (False, self.tokenizer)):
            if kind in plain:
                found[kind] = iter(tokenizer.encode_batch_fast([t for t, p in zip(texts, plain) if p == kind], **options))
        return (next(found[p]) for p in plain)

    def _encodings(self, texts: pa.Array, ask) -> Iterator:
        whole = [t or "" for t in texts.to_pylist()]
        for i, j in by_size([len(t) for t in whole], SLICE):
            yield from ask(whole[i:j], add_special_tokens=False)


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """This worker's encoder, kept from task to task."""
    return Encoder(name)


def by_size(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to at most ``most``, or of one item."""
    i, total = 0, 0
    for j, size in enumerate(sizes):
        if j > i and total + size > most:
            yield i, j
            i, total = j, 0
        total += size
    if sizes:
        yield i, len(sizes)
