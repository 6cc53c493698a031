"""Token counts by rank-synchronous merging of ragged arrays.

Per Arrow batch the texts are split into chunks, the pre-tokens that the
worker has not met yet are laid out as one ragged numpy array of symbol ids,
and all of them are merged at once: each round finds every sequence's
lowest-rank adjacent pair and applies it in all sequences simultaneously, until
no pair is left. The surviving symbols are the tokens; their numbers go to a
memo, bounded in bytes, and are summed per text. Texts with rare white space are
split by the tokenizer's own rules; long chunks are counted and not kept. Normalising and pre-tokenising rules come
from the tokenizer file; the merging is done here.

Defined cases: null and empty texts count 0 tokens and 0 bytes; a special
token's string inside a text counts as one token, as in the library's default;
any other text is counted whole, however long; repeated rows are counted each;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .tokens import ENTRY_BYTES, LONG_CHUNK, MEMO_BYTES, ODD_SPACE, layout, tokenizer_path

ROW_CHUNKS = 200_000       # chunks of texts that are looked up together

class MergeTable:
    """Rank and result of a symbol pair, looked up for whole arrays."""

    def __init__(self, pairs: np.ndarray, made: np.ndarray):
        self.bits = 19
        todo, self.levels = np.arange(len(pairs)), []
        while len(todo):  # each level takes one pair per slot; the rest go to the next
            mult = np.uint64(0x9E3779B97F4A7C15 + 2 * 0x5851F42D4C957F2D * (len(self.levels) + 1) & (1 << 64) - 1 | 1)
            at = self._slot(pairs[todo], mult)
            _, first = np.unique(at, return_index=True)
            keys = np.full(1 << self.bits, -1, np.int64)
            ranks = np.zeros(1 << self.bits, np.int32)
            keys[at[first]], ranks[at[first]] = pairs[todo[first]], todo[first]
            self.levels.append((mult, keys, ranks))
            todo = np.delete(todo, first)
        self.made = made

    def _slot(self, pairs: np.ndarray, mult: np.uint64) -> np.ndarray:
        return ((pairs.astype(np.uint64) * mult) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, pairs: np.ndarray) -> np.ndarray:
        out = np.full(len(pairs), NO_RANK, np.int32)
        for mult, keys, ranks in self.levels:
            at = self._slot(pairs, mult)
            hit = keys[at] == pairs
            out[hit] = ranks[at[hit]]
        return out


NO_RANK = np.int32(2**31 - 1)


def merge_counts(symbols: np.ndarray, offs: np.ndarray, table: MergeTable) -> np.ndarray:
    """Number of symbols that survive in each sequence of a ragged array."""
    counts = np.diff(offs)
    seq = np.repeat(np.arange(len(counts)), counts)
    while len(symbols) > 1:
        same = seq[1:] == seq[:-1]
        rank = np.full(len(symbols), NO_RANK, np.int32)  # of the pair that begins here
        pairs = (symbols[:-1].astype(np.int64) << 32) | symbols[1:]
        rank[:-1][same] = table.rank(pairs[same])
        begin = np.flatnonzero(np.concatenate([[True], ~same]))
        sizes = np.diff(np.append(begin, len(symbols)))
        low = np.minimum.reduceat(rank, begin)
        live = np.repeat(low != NO_RANK, sizes)
        if not live.any():
            break
        hit = live & (rank == np.repeat(low, sizes))
        # in a run of overlapping hits (aaa) every second one merges, from the left
        at = np.flatnonzero(hit)
        run = np.concatenate([[True], np.diff(at) > 1])
        since = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[since % 2 == 0]
        symbols = symbols.copy()
        symbols[at] = table.made[rank[at]]
        keep = live
        keep[at + 1] = False
        np.subtract.at(counts, seq[at], 1)
        symbols, seq = symbols[keep], seq[keep]  # finished sequences leave as well
    return counts


class TokenCounter:
    """Token numbers of whole texts for a byte-pair model of a ``tokenizers`` file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if layout(spec) != "dropped":
            raise ValueError("token counts need a byte-pair model whose pre-tokens drop white space")
        tok = Tokenizer.from_file(path)
        self.normalize, self.pretokens = tok.normalizer.normalize_str, tok.pre_tokenizer.pre_tokenize_str
        model = spec["model"]
        self.vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in merges], np.int64)
        right = np.array([self.vocab[b] for _, b in merges], np.int64)
        made = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        self.table = MergeTable((left << 32) | right, made)
        special = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(special)) if special else None
        self.odd = re.compile(f"[{ODD_SPACE}]")
        self.memo: dict[str, int] = {}      # chunk -> tokens
        self.pre_memo: dict[str, int] = {}  # pre-token -> tokens
        self.held = 0                       # bytes of both, about

    def _split(self, chunk: str) -> list[str]:
        if chunk[0] == "\0":  # a pre-token already
            return [chunk[1:]]
        if chunk.isascii():
            word = chunk.lower()
            if word.isalpha():
                return [word]
            if word[:-1].isalpha() and word[-1] in ",.;:!?":
                return [word[:-1], word[-1]]
        return [p for p, _ in self.pretokens(self.normalize(chunk))]

    def _learn(self, chunks: list[str]) -> dict[str, int]:
        """Tokens of chunks not met before: one ragged array for all their pre-tokens. Long ones are not kept."""
        parts = {c: self._split(c) for c in chunks}
        new = [p for p in dict.fromkeys(p for ps in parts.values() for p in ps) if p not in self.pre_memo]
        found: dict[str, int] = {}
        for i in range(0, len(new), 50_000):
            block = new[i:i + 50_000]
            offs = np.concatenate([[0], np.cumsum([len(p) for p in block])])
            vocab, suffix = self.vocab, self.suffix
            symbols = np.array([vocab[s] for p in block for s in (*p[:-1], p[-1] + suffix)], np.int64)
            found.update(zip(block, merge_counts(symbols, offs, self.table).tolist()))
        known = self.pre_memo
        for p, n in found.items():
            if len(p) <= LONG_CHUNK:
                known[p] = n
                self.held += len(p) + ENTRY_BYTES
        out = {c: sum([found[p] if p in found else known[p] for p in ps]) for c, ps in parts.items()}
        for c, n in out.items():
            if len(c) <= LONG_CHUNK:
                self.memo[c] = n
                self.held += len(c) + ENTRY_BYTES
        return out

    def _chunks(self, text: str) -> list[str]:
        if self.odd.search(text):  # the tokenizer's own rules bound the pre-tokens
            return ["\0" + p for p, _ in self.pretokens(self.normalize(text))]
        return text.split()

    def _counts(self, rows: list[list[str]]) -> list[int]:
        """Tokens of some rows of chunks, whose distinct chunks fit the memo."""
        get = self.memo.__getitem__
        try:
            return [sum(map(get, r)) for r in rows]
        except KeyError:
            pass
        if self.held >= MEMO_BYTES:
            self.memo.clear()
            self.pre_memo.clear()
            self.held = 0
        memo = self.memo
        new = self._learn(list({c for r in rows for c in r if c not in memo}))
        return [sum([memo[c] if c in memo else new[c] for c in r]) for r in rows]

    def count_batch(self, texts: list[str | None]) -> list[int]:
        out, rows, at, held = [], [], [], 0

        def count():
            for i, n in zip(at, self._counts(rows)):
                out[i] += n
            rows.clear(), at.clear()

        for t in texts:
            t = t or ""
            pieces, special = [t] if t else [], 0
            if self.special is not None and "<|" in t and self.special.search(t):
                pieces = self.special.split(t)
                special = len(pieces) - 1
            out.append(special)
            chunks = [c for p in pieces for c in self._chunks(p)] if len(pieces) != 1 else self._chunks(t)
            for i in range(0, len(chunks), ROW_CHUNKS):  # a very long text in parts
                rows.append(chunks[i:i + ROW_CHUNKS] if len(chunks) > ROW_CHUNKS else chunks)
                at.append(len(out) - 1)
                held += len(rows[-1])
                if held >= ROW_CHUNKS:
                    count()
                    held = 0
        count()
        return out


_COUNTERS: dict[str, TokenCounter] = {}


def count_tokens(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048,
                 slice_chars: int = 1 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document."""
    C.bound_batches(docs.sparkSession)
    path = tokenizer_path(tokenizer)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if path not in _COUNTERS:
            _COUNTERS[path] = TokenCounter(path)
        counter = _COUNTERS[path]
        for b in batches:
            texts, out, held, size = list(b), [], [], 0
            for t in texts:
                held.append(t)
                size += len(t or "")
                if size >= slice_chars:
                    out += counter.count_batch(held)
                    held, size = [], 0
            yield pd.Series(out + counter.count_batch(held), dtype="int64")

    text = C.text_or_empty()
    return (docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), tokens(text).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
