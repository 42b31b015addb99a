"""Whole texts to token ids with a public tokenizer, each different piece once.

Both tokenizers cut a text into pieces before anything else, so a text's ids are the
ids of its pieces in order. Other tokenizers are refused. The pieces of a group of texts are found and
told apart in whole arrays; a worker encodes each different one once, many at a
time with a special token between them, and keeps those of two generations of up
to ``KEPT`` pieces for later groups. A worker that goes on to other work lets go
of them.
"""

from __future__ import annotations

import json
import re
import threading
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

#: Pieces in a generation. At the next one the younger becomes the older, and what of it is used again moves up.
KEPT = 700_000
#: Seconds without a text after which the pieces kept are let go, as the worker may serve another stage by then.
IDLE = 3.0
#: Characters of text cut into pieces at a time.
CUT = 2_000_000
#: Pieces encoded in one string.
JOINED = 512

#: The code points of the Unicode property White_Space.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: A space belongs to the word after it; of other runs the last blank stands alone before a word.
SPACED = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: White space has no ids.
BARE = re.compile(f"[^{_SPACE}]+|[{_SPACE}]+")
_BLANK = re.compile(f"[{_SPACE}]")
#: Within words both tokenizers go on to cut letters, numbers and other signs apart. Of code points whose kind has
#: long been settled (Latin, Greek and Cyrillic, common punctuation) that is done here too, so that a word is one piece
#: whatever stands around it; a text with others is cut at white space alone, which is right for any.
_SPACES, _LETTER, _NUMBER, _OTHER, _UNSURE = range(5)
_SETTLED = [range(0x250), range(0x2010, 0x2028), range(0x2030, 0x205F), range(0x20AC, 0x20AD), range(0x391, 0x3A2), range(0x3B1, 0x3CA), range(0x400, 0x460)]
_KIND = np.full(0x20AE, _UNSURE, np.uint8)
for _range in _SETTLED:
    for _point in _range:
        _letter = unicodedata.category(chr(_point))[0]
        _KIND[_point] = _SPACES if _BLANK.match(chr(_point)) else {"L": _LETTER, "N": _NUMBER}.get(_letter, _OTHER)
#: The short forms that both tokenizers cut off after an apostrophe; the one of bare words lower-cases first.
_SHORT = {False: re.compile("'(?:[stmd]|re|ve|ll)"), True: re.compile("'(?:[stmd]|re|ve|ll)", re.IGNORECASE | re.ASCII)}
#: Pieces whose ids are put together at a time.
GATHERED = 500_000

_OPEN: dict[tuple, Encoder] = {}


#: How the two public tokenizers cut texts before they look at words.
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_CUTS = {
    SPACED: (None, _BYTES | {"use_regex": True}),
    BARE: (
        [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
        [{"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}, _BYTES | {"use_regex": False}],
    ),
}


def _check(kept: dict, pieces: re.Pattern) -> None:
    """Raises for a tokenizer that cuts texts in another way than ``pieces`` stands for: its ids would be wrong."""
    normal, cut = kept.get("normalizer"), kept.get("pre_tokenizer")
    found = (normal and normal.get("normalizers"), cut and cut.get("pretokenizers", cut))
    if pieces not in _CUTS or found != _CUTS[pieces]:
        raise ValueError("this tokenizer cuts texts in a way that is not known here")


class Encoder:
    """Ids of whole texts as little-endian bytes. Strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str, pieces: re.Pattern, dtype: str) -> None:
        from tokenizers import Tokenizer

        self.path, self.pieces, self.dtype, self.kept, self.older = path, pieces, dtype, {}, {}
        self.held, self.timer = threading.Lock(), None
        self.joined = Tokenizer.from_file(path)
        _check(json.loads(self.joined.to_str()), pieces)
        special = {i: t for i, t in self.joined.get_added_tokens_decoder().items() if not (t.lstrip or t.rstrip)}
        self.stop = max(special)
        self.mark, self.marks = special[self.stop].content, [t.content for t in self.joined.get_added_tokens_decoder().values()]

    @cached_property
    def plain(self):
        """Takes strings of special tokens as text; few texts need it."""
        from tokenizers import Tokenizer

        plain = Tokenizer.from_file(self.path)
        plain.encode_special_tokens = True
        return plain

    def _starts(self, text: str, raw: bytes) -> np.ndarray:
        """Where the text's pieces begin in its bytes; together they are the whole text."""
        if not raw:
            return np.empty(0, np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = _KIND[np.minimum(points, len(_KIND) - 1)]
        bare = self.pieces is BARE
        if (kind == _UNSURE).any() or bare and ("\u0130" in text or not unicodedata.is_normalized("NFC", text)):
            sizes = [len(p.encode()) for p in self.pieces.findall(text)]  # at white space only
            return np.cumsum([0, *sizes[:-1]])
        starts = np.ones(len(points), bool)
        starts[1:] = kind[1:] != kind[:-1]
        if bare:
            starts |= kind == _NUMBER
        else:
            before = (kind[:-1] == _SPACES) & (kind[1:] != _SPACES)  # the last blank before a word
            starts[:-1] |= before
            starts[1:] &= ~(before & (points[:-1] == 32))  # a space belongs to the word
        for q in np.flatnonzero((points == 39) & starts).tolist():
            found = _SHORT[bare].match(text, q)
            if found:
                starts[q + 1] = False
                if found.end() < len(points) and kind[found.end()] != _SPACES:
                    starts[found.end()] = True
        at = np.flatnonzero(starts)
        if len(raw) == len(points):
            return at
        return np.r_[0, np.cumsum(1 + (points > 0x7F) + (points > 0x7FF))[at[1:] - 1]]

    def _learn(self, wanted: list[bytes]) -> None:
        missing = [p for p in wanted if p not in self.kept]
        if len(self.kept) + len(missing) > KEPT:
            self.older, self.kept, missing = self.kept, {}, wanted
        new = []
        for p in missing:
            if p in self.older:
                self.kept[p] = self.older[p]
            else:
                new.append(p)
        for at in range(0, len(new), JOINED):
            part = new[at : at + JOINED]
            texts = [p.decode() for p in part]
            if self.pieces is BARE:
                self.kept.update((p, b"") for p, t in zip(part, texts, strict=True) if _BLANK.match(t))
                part, texts = [p for p, t in zip(part, texts, strict=True) if not _BLANK.match(t)], [t for t in texts if not _BLANK.match(t)]
                if not part:
                    continue
            joined = self.mark.join(texts)
            if joined.count(self.mark) >= len(part) or any(m in joined for m in self.marks if m != self.mark):
                self.kept.update((p, np.array(self.plain.encode(t, add_special_tokens=False).ids, self.dtype).tobytes()) for p, t in zip(part, texts, strict=True))
                continue
            ids = np.array(self.joined.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.dtype)
            width, raw = ids.itemsize, ids.tobytes()
            stops = np.flatnonzero(ids == self.stop) * width
            starts, ends = [0, *(stops + width).tolist()], [*stops.tolist(), len(raw)]
            self.kept.update(zip(part, [raw[a:b] for a, b in zip(starts, ends, strict=True)], strict=True))

    def _let_go(self) -> None:
        with self.held:
            self.kept, self.older = {}, {}

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        if self.timer:
            self.timer.cancel()
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= CUT:
                yield from self._encode(group)
                group, size = [], 0
        yield from self._encode(group)
        self.timer = threading.Timer(IDLE, self._let_go)
        self.timer.daemon = True
        self.timer.start()

    def _encode(self, texts: list[str]) -> list[bytes]:
        raws = [t.encode() for t in texts]
        starts = [self._starts(t, raw) for t, raw in zip(texts, raws, strict=True)]
        counts = np.cumsum([len(s) for s in starts], dtype=np.int64)
        bases = np.cumsum([0, *map(len, raws)])
        offsets = np.concatenate([*[s + b for s, b in zip(starts, bases, strict=False)], bases[-1:]])
        kind = np.dtype(self.dtype)
        if not len(offsets) - 1:
            return [b""] * len(texts)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(b"".join(raws))])
        coded = pieces.dictionary_encode()
        codes, different = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        with self.held:
            self._learn(different)
            ids = [self.kept[p] for p in different]
        sizes = np.array([len(x) for x in ids], np.int64) // kind.itemsize
        flat, first = np.frombuffer(b"".join(ids), kind), np.cumsum(sizes) - sizes
        parts = []
        for at in range(0, len(codes), GATHERED):
            code = codes[at : at + GATHERED]
            n = sizes[code]
            parts.append(flat[np.arange(n.sum()) + np.repeat(first[code] - (np.cumsum(n) - n), n)])
        out = np.concatenate(parts).tobytes()
        ends = np.r_[0, np.cumsum(sizes[codes])][counts] * kind.itemsize
        return [out[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def encoder(path: str, pieces: re.Pattern, dtype: str = "<u4") -> Encoder:
    """The worker's encoder of this kind; opened once and kept between tasks."""
    key = path, pieces.pattern, dtype
    if key not in _OPEN:
        _OPEN[key] = Encoder(path, pieces, dtype)
    return _OPEN[key]
