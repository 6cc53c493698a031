"""Whole-text token ids by the ``tokenizers`` library, with a bounded memo of chunks.

For two known tokenizer layouts every text splits at white space into chunks
whose ids do not depend on their neighbours, so each distinct chunk is encoded
by the library once per worker and the ids of a text are a join of memo
entries. Any text or layout outside the proven conditions is encoded whole by
the library, so the ids always equal the library's.
"""

from __future__ import annotations

import json
import os
import re
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Control and rare white-space characters on which libraries may disagree.
ODD_SPACE = "".join(map(chr, [0, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029,
                             0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]))
MEMO_BYTES = 224 << 20  # of a worker's memo, an entry's own ENTRY_BYTES included; when full, the half learnt last goes
ENTRY_BYTES, LONG_CHUNK = 200, 200  # longer chunks (characters) are not kept


def tokenizer_path(name: str) -> str:
    """Place of an installed public tokenizer file; a path is returned as it is."""
    if os.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def layout(spec: dict) -> str:
    """How white space bounds tokens: 'dropped', 'leading' (a space starts the next token) or 'none'."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "leading"
    parts = pre.get("pretokenizers") or []
    norms = [n.get("type") for n in (norm or {}).get("normalizers", [])]
    if (pre.get("type") == "Sequence" and len(parts) == 2 and parts[0].get("type") == "Split"
            and parts[0].get("invert") and parts[0].get("behavior") == "Removed"
            and parts[0]["pattern"].get("Regex", "").endswith("|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
            and parts[1].get("type") == "ByteLevel" and not parts[1].get("add_prefix_space")
            and norms == ["NFC", "Replace", "Lowercase"]):
        return "dropped"
    return "none"


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies, for ``str.translate`` of latin-1 text."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


SYMBOLS = byte_symbols()


class OddChunk(Exception):
    """A chunk that may not stand alone: its text is encoded whole."""


class Memo(dict):
    """Ids of the chunks seen so far; an unknown one is learnt when it is asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, chunk: str) -> bytes:
        return self.learn(chunk)


class ChunkEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, no special tokens added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.layout = layout(spec)
        added = [t["content"] for t in spec.get("added_tokens", [])]
        odd = [*map(re.escape, added), f"[{ODD_SPACE}]"]
        # an added token with white space in it lies across chunks
        self.by_chunk = self.layout == "leading" and not any(re.search(r"\s", t) for t in added)
        self.odd_chunk = re.compile("|".join([*odd, r"[\t\x0b\x0c\r]", r"^ \Z"]))
        if self.layout == "leading":  # any run of two white-space characters with a space or line end in it
            odd += [r"\s\s", r"[\t\x0b\x0c\r]", r"^\s", r"\s\Z"]
        self.odd = re.compile("|".join(odd))
        self.memo = Memo(self._learn)
        self.held = 0

    def _ids(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Ids of one chunk; plain words go straight to the model, a trailing mark is split off."""
        word = chunk[1:] if self.layout == "leading" and chunk[0] == " " else chunk
        if word.isascii() and word.isalpha():
            piece = word.lower() if self.layout == "dropped" else ("\u0120" + word if len(word) < len(chunk) else word)
            return array("I", [t.id for t in self.tok.model.tokenize(piece)]).tobytes()
        if self.layout == "leading" and word.isalpha() and max(word) < "\u0250":
            piece = chunk.encode().decode("latin-1").translate(SYMBOLS)
            return array("I", [t.id for t in self.tok.model.tokenize(piece)]).tobytes()
        if len(word) > 1 and word[-1] in ",.;:!?" and word[:-1].isalpha() and max(word) < "\u0250":
            return self.memo[chunk[:-1]] + self.memo[word[-1]]
        return self._ids(chunk)

    def _learn(self, chunk: str) -> bytes:
        if self.by_chunk and self.odd_chunk.search(chunk):
            raise OddChunk
        got = self._chunk(chunk)
        if len(chunk) <= LONG_CHUNK:
            if self.held >= MEMO_BYTES:  # frequent chunks are met early, so the first half stays
                while self.held > MEMO_BYTES // 2:
                    old, ids = self.memo.popitem()
                    self.held -= len(old) + len(ids) + ENTRY_BYTES
            self.memo[chunk] = got
            self.held += len(chunk) + len(got) + ENTRY_BYTES
        return got

    def _odd(self, text: str) -> bool:
        """Whether the text is outside the proven conditions, but for what its chunks tell when they are learnt."""
        if self.by_chunk:
            return "\0" in text or "\n\n" in text or "\n " in text or text[0].isspace() or text[-1].isspace()
        return self.layout == "none" or self.odd.search(text) is not None

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._odd(text):
            return self._ids(text)
        if self.layout == "leading":
            chunks = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        else:
            chunks = text.split()
        try:
            return b"".join(map(self.memo.__getitem__, chunks))
        except OddChunk:
            return self._ids(text)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file (kept while the worker lives)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
