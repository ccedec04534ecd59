"""Byte-level BPE ids as the tokenizers library gives them, remembered by unit.

Between a non-space and a non-space, a single space always starts a new unit of a
byte-level pre-tokenizer, so a text may be cut there and each unit encoded once per
worker process.  In such a vocabulary ids grow in merge order, so tiktoken, which is
several times faster, gives the same ids from the same file; this is checked when the
file is read.  Units that hold an added token go to the tokenizers library itself.
"""

from __future__ import annotations

import json
import os
import re
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
SEAM = re.compile(r"(?<=\S) (?=\S)")
RARE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0  -     　]")
# fixed value: the pre-tokenizing pattern of byte-level BPE
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 250_000  # units remembered per generation; memory only, never results


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteTokenizer:
    def __init__(self, file: str):
        import tiktoken
        from tokenizers import Tokenizer
        with open(file, encoding="utf-8") as opened:
            described = json.load(opened)
        split = described["pre_tokenizer"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in described["model"]["merges"]]
        added = [t["content"] for t in described["added_tokens"]]
        vocabulary = {t: i for t, i in described["model"]["vocab"].items() if t not in added}
        order = [vocabulary[a + b] for a, b in merges]
        if (described["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"]
                or not split["use_regex"] or order != sorted(order)):
            raise ValueError("only plain byte-level vocabularies in merge order are handled")
        letters = byte_letters()
        self.model = Tokenizer.from_file(file)
        self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            bytes(letters[c] for c in token): i for token, i in vocabulary.items()})
        self.added = re.compile("|".join(re.escape(t) for t in added) or r"(?!)")
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, text: str) -> list[int]:
        if self.added.search(text):
            return self.model.encode(text, add_special_tokens=False).ids
        return self.ranks.encode_ordinary(text)

    def units(self, text: str) -> list[str]:
        if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or RARE.search(text):
            parts = SEAM.split(text)
        else:
            parts = text.split(" ")
        parts[0] = " " + parts[0]  # only the first unit has no space before it; no other begins with one
        return parts

    def encoded(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit integers (little-endian machines)."""
        split = [self.units(t) for t in texts]
        memo, older = self.memo, self.older
        for unit in set().union(*split).difference(memo):
            kept = older.get(unit)
            if kept is None:
                kept = array("I", self.ids(unit[1:] if unit[:1] == " " else " " + unit)).tobytes()
            memo[unit] = kept
        out = [b"".join([memo[u] for u in units]) for units in split]
        if len(memo) >= MEMO:
            self.memo, self.older = {}, memo
        return out


_TOKENIZERS: dict[str, ByteTokenizer] = {}


def tokenizer(file: str) -> ByteTokenizer:
    if file not in _TOKENIZERS:
        _TOKENIZERS[file] = ByteTokenizer(file)
    return _TOKENIZERS[file]
