"""Token ids of whole texts by words, with a memo per worker that is bounded in bytes.

For a tokenizer that drops white space, no token crosses ASCII white space, so a text's ids are its words' ids in a
row.  Each worker keeps the ids of words it has met, and of the parts that words split into: words are far more varied
than parts, as case and marks around a word make another word but the same part.  A word of plain characters goes through
the tokenizer's rules step by step (lower case, split pattern, byte letters) into its merge model; any other goes through
the tokenizer itself.

The rules are read from the tokenizer file.  `Rules.read` accepts a file only if its normaliser, splitter and model are of
the shape that this cut needs and if both ways agree on a set of probes; for any other file whole texts go through the
library.
"""

from __future__ import annotations

import json
import string
from dataclasses import dataclass

import regex

from millrace.llm.common import worker_memo

# A memo holds two generations of at most so many bytes; longer words are not kept.
WORD_BYTES, PART_BYTES, KEEP_BYTES = 96_000_000, 32_000_000, 200
_ENTRY = 160  # what an entry takes besides its bytes


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The usual printable letter for each byte: itself if printable, else the next free one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


_LETTERS = _byte_letters()
_ENDS = b".,;:!?"
_SPACES = "\t\n\x0b\x0c\r "
# Precomposed Latin letters, unchanged by NFC and with lower-case forms of one letter.
_LATIN = "À-įĲ-ž"


def _packed(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


@dataclass(frozen=True)
class Rules:
    """The split pattern of a tokenizer, and the words that may go through its rules step by step."""

    split: regex.Pattern
    plain: regex.Pattern
    special: tuple[bytes, ...]

    @staticmethod
    def read(path: str, whole) -> Rules | None:
        """The rules of the file if words can be encoded one by one by them, else None."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec["normalizer"] or {}).get("normalizers") or []
        parts = (spec["pre_tokenizer"] or {}).get("pretokenizers") or []
        spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        if steps != [{"type": "NFC"}, spaces, {"type": "Lowercase"}] or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
            return None
        cut, letters, model = parts[0], parts[1], spec["model"]
        shape = cut["behavior"] == "Removed" and cut["invert"] and "Regex" in cut["pattern"]
        shape = shape and not letters["add_prefix_space"] and not letters["use_regex"] and not spec["truncation"] and not spec["padding"]
        shape = shape and model["type"] == "BPE" and not model["dropout"] and not model["continuing_subword_prefix"] and not model["ignore_merges"]
        specials = [t["content"] for t in spec["added_tokens"]]
        marks = {s[0] for s in specials if s}
        if not shape or not all(specials) or any(s.split() != [s] for s in specials) or any(m.isalnum() or not m.isascii() for m in marks):
            return None
        ascii_ = "".join(regex.escape(c) for c in map(chr, range(0x21, 0x7F)) if c not in marks)
        rules = Rules(regex.compile(cut["pattern"]["Regex"]), regex.compile(f"[{ascii_}{_LATIN}]+"), tuple(s.encode().lower() for s in specials))
        return rules if rules.agree(whole) else None

    def agree(self, whole) -> bool:
        """White space is in no part, and both ways give the same ids, on probes with every plain character."""
        for space in _SPACES:
            if any(set(p) & set(_SPACES) for text in (space, f"a{space}1", f"'{space}s") for p in self.split.findall(text)):
                return False
        # Runs of a-z are one part, and a mark behind them another: such words need no pattern.
        if any(self.split.findall(c * n) != [c * n] for c in string.ascii_lowercase for n in (1, 2, 7)):
            return False
        if any(self.split.findall(f"st{m}") != ["st", m] for m in _ENDS.decode()):
            return False
        marks = [c for c in map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x17F)]) if self.plain.fullmatch(c)]
        probes = [w for c in marks for w in (c, f"the{c}", f"{c}{c}s", f"a'{c}1{c}x")]
        return all(_packed(self.ids(w, whole.model)) == _packed(whole.encode(w, add_special_tokens=False).ids) for w in probes)

    def ids(self, word: str, model) -> list[int]:
        return [i for part in self.split.findall(word.lower()) for i in part_ids(part, model)]


def part_ids(part: str, model) -> list[int]:
    return [t.id for t in model.tokenize(part if part.isascii() else "".join([_LETTERS[b] for b in part.encode()]))]


class Memo(dict):
    """The younger of two generations; an entry of the older one that is asked for again moves up."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older, self.bytes = make, limit, {}, 0

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        size = len(key) + len(value)
        if len(key) <= KEEP_BYTES:
            if self.bytes + size + _ENTRY > self.limit:
                self.older, self.bytes = dict(self), 0
                self.clear()
            self.bytes += size + _ENTRY
            self[key] = value
        return value


class WordIds:
    """Texts (UTF-8) to their ids as little-endian 32-bit bytes."""

    def __init__(self, path: str, word_bytes: int = WORD_BYTES, part_bytes: int = PART_BYTES):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.rules = Rules.read(path, self.whole)
        self.words = Memo(self.encode, word_bytes)
        self.parts = Memo(lambda part: _packed(part_ids(part, self.model)), part_bytes)

    def encode(self, word: bytes) -> bytes:
        """The ids of a word without ASCII white space."""
        if len(word) <= 100 and word.islower():
            if word.isalpha():
                return self.parts[word.decode()]
            if word[-1] in _ENDS and word[:-1].isalpha():
                return self.parts[word[:-1].decode()] + self.parts[chr(word[-1])]
        text = word.decode()
        if len(text) <= 100 and self.rules.plain.fullmatch(text):
            return b"".join([self.parts[part] for part in self.rules.split.findall(text.lower())])
        return _packed(self.whole.encode(text, add_special_tokens=False).ids)

    def text_ids(self, text: bytes) -> bytes:
        if self.rules is None:
            return _packed(self.whole.encode(text.decode(), add_special_tokens=False).ids)
        # Lower case comes anyway; only special strings are told apart by it.
        low = text.lower()
        if not any(s in low for s in self.rules.special):
            text = low
        return b"".join(map(self.words.__getitem__, text.split()))


def word_ids(path: str) -> WordIds:
    return worker_memo(f"word_ids:{path}", lambda: WordIds(path))
