"""Token ids of whole texts, by the ``tokenizers`` library, word by word.

Both kinds of vocabulary used here cut a text at every single space or line
break between two non-space characters, whatever stands around it: a
byte-level BPE keeps that space at the head of the following word (and a line
break as a token of its own), a word BPE drops both.  So the ids of a text are
the ids of its pieces in order, and every distinct piece is encoded once per
worker; a full cache keeps the pieces that came back.  New pieces are encoded
joined into longer texts, whose ids show where each one begins or ends.  Texts where a
space or line break touches other white space or an end of the text, and
vocabularies with other rules, are encoded whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_CACHED = 600_000          # pieces (about 100 MB of a worker); beyond either bound those used once go
MAX_CACHED_BYTES = 16 << 20
SLICE_BYTES = 1 << 20         # text encoded at once
JOINED = 256                  # new pieces encoded as one text

_WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CLOSING = '.,!?;:#$%&*"'
_CUT = "\x1f"                 # stands between pieces; a text that holds it is encoded whole
_IRREGULAR = rf"(\A|{_WS})[ \n]|[ \n]({_WS}|\z)|\x{{1f}}"


def _space_rule(path: str) -> str:
    """'keeps' (the space heads the next piece), 'drops', or 'whole'."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "keeps"
    steps = pre.get("pretokenizers") or [{}]
    if steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert"):
        return "drops"
    return "whole"


def _spans(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places start .. start + length - 1 of every span, behind one another."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(int(ends[-1]) if len(ends) else 0)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum())), lens


class PieceTokenizer:
    def __init__(self, path: str, end_id: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.rule, self.end_id = Tokenizer.from_file(path), _space_rule(path), end_id
        self.edges = self._edges()
        self._clear()

    def _edges(self) -> np.ndarray | None:
        """By id: whether it begins a piece with its space ('keeps') or ends a word ('drops'); None: no id shows it."""
        if self.rule == "whole":
            return None
        vocab = self.tokenizer.get_vocab()
        table = np.zeros(max(vocab.values()) + 1, bool)
        if self.rule == "keeps":
            table[[i for token, i in vocab.items() if token[:1] in ("\u0120", "\u010a")]] = True     # space, line break
        else:
            table[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        return table if table.any() else None

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.cached_bytes = 0
        self.starts, self.lens = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.uses = np.zeros(0, np.int32)

    def _shrink(self) -> None:
        """Forget the pieces that no second slice used; the cache starts anew if that leaves more than half."""
        kept = self.uses > 1
        pieces = list(compress(self.index, kept.tolist()))
        if 2 * len(pieces) > MAX_CACHED or 2 * sum(map(len, pieces)) > MAX_CACHED_BYTES:
            self._clear()
            return
        flat, lens, uses = self._gather(np.flatnonzero(kept)), self.lens[kept], self.uses[kept] >> 1
        self._clear()
        self._add(pieces, flat, lens)
        self.uses = uses

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of each); those that show one edge each are joined and parted there."""
        keeps = self.rule == "keeps"
        if self.edges is None:
            plain = [False] * len(pieces)
        elif keeps:                                         # printable: no white space but the space in front
            plain = [p.rfind(" ") == 0 and len(p) > 1 and p.isprintable() for p in pieces]
        else:                                               # letters only: one word
            plain = [p.isalpha() for p in pieces]
        alone, joined = [p for p, is_plain in zip(pieces, plain) if not is_plain], list(compress(pieces, plain))
        flat, lens = _flat(self._encode(alone))
        flats, counts = [flat], [lens]
        groups = [joined[i: i + JOINED] for i in range(0, len(joined), JOINED)]
        for group, ids in zip(groups, self._encode([("" if keeps else " ").join(g) for g in groups])):
            ids = np.array(ids, np.uint32)
            at = np.flatnonzero(self.edges[ids])
            lens = np.diff(at, append=len(ids)) if keeps else np.diff(at, prepend=-1)
            if len(at) != len(group) or lens.sum() != len(ids):
                ids, lens = _flat(self._encode(group))
            flats.append(ids)
            counts.append(lens)
        flat, lens = np.concatenate(flats), np.concatenate(counts)
        plain = np.array(plain, bool)
        back = np.empty(len(pieces), np.int64)              # where each piece's ids went
        back[np.concatenate((np.flatnonzero(~plain), np.flatnonzero(plain)))] = np.arange(len(pieces))
        return flat[_spans((np.cumsum(lens) - lens)[back], lens[back])], lens[back]

    def _add(self, pieces: list[str], flat: np.ndarray, lens: np.ndarray) -> None:
        at = len(self.lens)
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(lens) - lens))
        self.lens = np.concatenate((self.lens, lens))
        self.flat = np.concatenate((self.flat, flat))
        self.uses = np.concatenate((self.uses, np.zeros(len(pieces), np.int32)))
        self.index.update(zip(pieces, range(at, at + len(pieces))))
        self.cached_bytes += sum(map(len, pieces))

    def _gather(self, codes: np.ndarray) -> np.ndarray:
        """The ids of cached pieces, behind one another."""
        return self.flat[_spans(self.starts[codes], self.lens[codes])]

    def _codes(self, pieces: list[str]) -> np.ndarray:
        """Cache positions of the (already prefixed) pieces; unseen ones are encoded.

        Closing signs after a letter are a token unit of their own under both
        rules, so a word is encoded once, with or without them.
        """
        get = self.index.get
        codes = np.fromiter(map(get, pieces, repeat(-1)), np.int64, len(pieces))
        unseen = np.flatnonzero(codes < 0)
        if len(unseen):
            fresh = [pieces[i] for i in unseen]
            cores = [p.rstrip(_CLOSING) for p in fresh]
            split = [len(c) < len(p) and c[-1:].isalpha() for p, c in zip(fresh, cores)]
            tails = {p[len(c):] for p, c, is_split in zip(fresh, cores, split) if is_split}
            need = [x for x in {c if is_split else p for p, c, is_split in zip(fresh, cores, split)} | tails
                    if x not in self.index]
            self._add(need, *self._encode_pieces(need))
            both = [(p, c) for p, c, is_split in zip(fresh, cores, split) if is_split and p not in self.index]
            halves = np.array([(self.index[c], self.index[p[len(c):]]) for p, c in both], np.int64).reshape(-1, 2)
            self._add([p for p, _ in both], self._gather(halves.ravel()), self.lens[halves].sum(axis=1))
            codes[unseen] = [self.index[p] for p in fresh]
        self.uses[codes] += 1                           # distinct pieces of one slice
        return codes

    def _by_piece(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > MAX_CACHED or self.cached_bytes > MAX_CACHED_BYTES:
            self._shrink()
        if self.rule == "keeps":                        # spaces and line breaks head the next piece
            texts = pc.replace_substring(pc.replace_substring(texts, " ", _CUT + " "), "\n", _CUT + "\n")
            lists = pc.split_pattern(texts, _CUT)
        else:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        bounds = lists.offsets.to_numpy()
        bounds = bounds - bounds[0]
        values = lists.flatten().dictionary_encode()
        codes = self._codes(values.dictionary.to_numpy(zero_copy_only=False).tolist())[values.indices.to_numpy()]
        return self._gather(codes), np.concatenate(([0], np.cumsum(self.lens[codes])))[bounds]

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of some texts."""
        odd = np.ones(len(texts), bool) if self.rule == "whole" else \
            pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._by_piece(texts)
        whole = iter(self._encode(texts.filter(pa.array(odd)).to_pylist()))
        ids, bounds = self._by_piece(texts.filter(pa.array(~odd))) if not odd.all() else (None, None)
        parts, k = [], 0
        for is_odd in odd:
            if is_odd:
                parts.append(np.array(next(whole), np.uint32))
            else:
                parts.append(ids[bounds[k]: bounds[k + 1]])
                k += 1
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def encode(self, column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(rows, ids, offsets) for slices of a text column; null counts as empty; the end id is included."""
        column = column.cast(pa.large_string()).fill_null("")
        ends = np.cumsum(pc.binary_length(column).to_numpy())
        i = 0
        while i < len(column):
            before = int(ends[i - 1]) if i else 0
            j = min(len(column), max(i + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))))
            ids, offsets = self._slice(column.slice(i, j - i))
            if self.end_id is not None:
                ids = np.insert(ids, offsets[1:], np.uint32(self.end_id))
                offsets = offsets + np.arange(len(offsets))
            yield slice(i, j), ids, offsets
            i = j


_LOADED: dict[tuple, PieceTokenizer] = {}


def tokenizer(path: str, end_id: int | None = None) -> PieceTokenizer:
    """One per worker process."""
    if (path, end_id) not in _LOADED:
        _LOADED[path, end_id] = PieceTokenizer(path, end_id)
    return _LOADED[path, end_id]
