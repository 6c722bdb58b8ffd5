"""Exact, batch-wise byte-level BPE encoding with the ``tokenizers`` library.

The library first splits a text into pieces (its pre-tokenizer's pattern) and
then merges bytes inside each piece, so the ids of a text are the ids of its
pieces, one after the other.  :class:`PieceEncoder` uses that: it splits texts
at single spaces (no piece goes over one), has the library's model encode
every *distinct* chunk once, keeps those ids in a bounded cache and assembles
the ids of all texts with NumPy gathers.  A text for which that split is not
known to be the library's own (see :data:`ODD`), or that holds an added token's string, goes to the library whole, so the
ids are the library's for every text.  A vocabulary file with another pre-tokenizer, a normalizer or another kind of model
(see :func:`splits_bytewise`) has all its texts encoded whole.

A text is held in memory with its ids: some twenty times its bytes while it is encoded whole, about eight times else.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The letters below are all of U+00C0 to U+024F but the two signs.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGNS = "¡¢£¤¥¦§¨©«¬®¯°±´¶·¸»¿×÷–—‘’“”…€•"
#: Texts made of these characters alone are split by PIECES.
PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LETTERS}{_SIGNS}]*")
#: Other texts, and white space where the pattern looks over a space, are not split at spaces.
ODD = rf"[^\t\n\r\x20-\x7e{_LETTERS}{_SIGNS}]|[\t\n\r ][\t\n\r ]|[\t\n\r ]$"
#: The byte-level pattern of the public vocabulary, written for those characters.
PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+"
)


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in kept}
    for n, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + n)
    return table


def splits_bytewise(settings: dict) -> bool:
    """Whether a vocabulary file's settings are those that PIECES stands for: byte-level pieces, merged by plain BPE."""
    model, before = settings.get("model") or {}, settings.get("pre_tokenizer") or {}
    return (
        settings.get("normalizer") is None and settings.get("truncation") is None and settings.get("padding") is None
        and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
    )


class _Index(dict):
    """Key -> position; a new key gets the next one and is noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key):
        self[key] = at = len(self)
        self.fresh.append(key)
        return at


class _Ragged:
    """Growing list of id sequences in two flat arrays."""

    def __init__(self):
        self.edges = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.n = 0

    def extend(self, ids: list[int], lengths: list[int]) -> None:
        while self.n + len(lengths) + 1 > len(self.edges):
            self.edges = np.concatenate([self.edges, np.zeros_like(self.edges)])
        used = self.edges[self.n]
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[used : used + len(ids)] = ids
        self.edges[self.n + 1 : self.n + 1 + len(lengths)] = used + np.cumsum(lengths)
        self.n += len(lengths)


class PieceEncoder:
    """Encodes Arrow string arrays; ``max_chunks`` bounds the cache of ids, ``slice_bytes`` the text held at once."""

    def __init__(self, path: str, max_chunks: int = 600_000, slice_bytes: int = 4 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        self.bytewise = splits_bytewise(settings)
        self.added = [t["content"] for t in settings.get("added_tokens") or () if t["content"]]
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.max_chunks, self.slice_bytes = max_chunks, slice_bytes
        self.index, self.store = _Index(), _Ragged()

    def _piece(self, piece: str) -> list[int]:
        at = self.index.get(piece, self.store.n)
        if at < self.store.n:
            return self.store.flat[self.store.edges[at] : self.store.edges[at + 1]].tolist()
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]

    def _learn(self) -> None:
        """Ids of the chunks met for the first time."""
        flat: list[int] = []
        lengths: list[int] = []
        for chunk in self.index.fresh:
            before = len(flat)
            for piece in PIECES.findall(chunk):
                flat += self._piece(piece)
            lengths.append(len(flat) - before)
        self.store.extend(flat, lengths)

    def _forget(self) -> None:
        """Chunks beyond the bound are not kept."""
        fresh, self.index.fresh = self.index.fresh, []
        for chunk in fresh[len(fresh) - max(0, len(self.index) - self.max_chunks) :]:
            del self.index[chunk]
        self.store.n = len(self.index)

    def _alone(self, text: str) -> np.ndarray:
        if not self.bytewise or not PLAIN.fullmatch(text) or any(t in text for t in self.added):
            return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        return np.array([i for piece in PIECES.findall(text) for i in self._piece(piece)], np.uint32)

    def encode(self, texts: pa.Array, end_id: int | None = None):
        """Yields, slice by slice, the ids of the texts one after the other (each followed by ``end_id``) and their counts."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // self.slice_bytes)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
            if hi > lo:
                yield self._encode(pc.fill_null(texts[lo:hi], ""), end_id)

    def _encode(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, ODD) if self.bytewise else pa.array([True] * len(texts), pa.bool_())
        for token in self.added if self.bytewise else ():
            odd = pc.or_(odd, pc.match_substring(texts, token))
        lists = pc.split_pattern(pc.replace_substring(pc.if_else(odd, "", texts), " ", "\0 "), "\0")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        if self.index.fresh:
            self._learn()
        at = at[coded.indices.to_numpy(zero_copy_only=False)]
        starts = self.store.edges[at]
        lengths = self.store.edges[at + 1] - starts
        after = np.cumsum(lengths)
        total = int(after[-1]) if len(after) else 0
        starts -= after - lengths
        ids = self.store.flat[np.repeat(starts, lengths) + np.arange(total)]
        self._forget()
        edges = np.concatenate([[0], after])[np.concatenate([[0], np.cumsum(counts)])]
        tokens = np.diff(edges)
        alone = {int(i): self._alone(texts[int(i)].as_py()) for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False))}
        if alone:
            ids = np.concatenate([alone.get(i, ids[edges[i] : edges[i + 1]]) for i in range(len(texts))])
            tokens = np.array([len(alone[i]) if i in alone else tokens[i] for i in range(len(texts))], np.int64)
        if end_id is not None:
            out = np.full(len(ids) + len(texts), end_id, np.uint32)
            out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), tokens)] = ids
            ids, tokens = out, tokens + 1
        return ids, tokens


_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def encoder(path: str, max_chunks: int = 600_000) -> PieceEncoder:
    """This process's encoder of a vocabulary file, with a cache of that size."""
    if (path, max_chunks) not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path, max_chunks] = PieceEncoder(path, max_chunks)
    return _ENCODERS[path, max_chunks]
