"""Splitting texts into pre-tokens exactly as the tokenizers library does.

Texts of characters whose class no Unicode version has changed are split by one
compiled pattern; any other text goes through the library's own normaliser and
pre-tokeniser. Special tokens are cut out of the raw text first, as the library does.
"""

from __future__ import annotations

import json
import re
import unicodedata

from pagelens.llm.common import worker_cache

#: Characters below this, and the listed punctuation, have had one class and no composition in all Unicode versions since 5.
_FIRST_COMBINING = 0x300
_STABLE = "‐-‧‰-‾€"


def _class(letter: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_FIRST_COMBINING) if unicodedata.category(chr(c))[0] == letter)


def _spaces() -> str:
    return "\t\n\x0b\x0c\r \x85\xa0"


def patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """(a character outside the stable ones, words of the word-end BPE, words of the byte-level BPE)."""
    cache = worker_cache()
    if "patterns" not in cache:
        a, n, s = _class("L"), _class("N"), _spaces()
        short = "'s|'t|'re|'ve|'m|'ll|'d"
        cache["patterns"] = (
            re.compile(f"[^\x00-{chr(_FIRST_COMBINING - 1)}{_STABLE}]"),
            re.compile(f"{short}|[{a}]+|[{n}]|[^{s}{a}{n}]+"),
            re.compile(f"{short}| ?[{a}]+| ?[{n}]+| ?[^{s}{a}{n}]+|[{s}]+(?![^{s}])|[{s}]+"))
    return cache["patterns"]


class Splitter:
    """The pre-tokens of a text for the tokenizer described by ``spec`` (the content of its JSON file)."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.special = {t["content"]: t["id"] for t in json.loads(spec)["added_tokens"] if t["special"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.lower = self.tokenizer.normalizer is not None
        self.odd, word, byte = patterns()
        self.pattern = word if self.lower else byte

    def plain(self, text: str) -> list[str]:
        if text.isascii() or not self.odd.search(text):
            return self.pattern.findall(text.lower() if self.lower else text)
        if not self.lower:
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def __call__(self, text: str | None) -> list[str]:
        """Pre-tokens in order; a special token's string stands for itself (no other pre-token can equal it)."""
        if not text:
            return []
        if not any(s in text for s in self.special):
            return self.plain(text)
        out = []
        for part in self.cut.split(text):
            out += [part] if part in self.special else self.plain(part) if part else []
        return out


def splitter(spec: str) -> Splitter:
    """The worker's splitter for this tokenizer."""
    cache = worker_cache().setdefault("splitters", {})
    key = hash(spec)
    if key not in cache:
        cache[key] = Splitter(spec)
    return cache[key]
