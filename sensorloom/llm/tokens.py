"""Token ids of whole texts, by the tokenizers library and a public vocabulary file.

A byte-level BPE never joins pieces across a lone blank or line feed that stands between two
other characters, nor across the border of a word and a final punctuation mark.  A text is cut
there, every piece is encoded once, all new ones of a group of texts in one go, and its ids come
from a bounded cache of Arrow columns afterwards.  Texts with other white space at a cut, or with a special token's
string, are encoded as a whole.
The tests hold both ways against each other.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_ENTRIES = 900_000
MARKS = tuple(".,;:!?")
# Characters of texts that are encoded together.
GROUP = 1 << 22
# New pieces that are encoded as one text: the library takes about 100 bytes a token.
TOGETHER = 1 << 15
# Below it are Latin letters alone, on which all versions of Unicode agree.
LETTERS_END = 0x250


def default_vocabulary() -> str:
    """Path of the public byte-level vocabulary with 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _ids(encoding) -> bytes:
    return np.array(encoding.ids, "<u4").tobytes()


def _letters(tokenizer, vocabulary: str):
    """The same model for pieces of letters alone, which the pattern of a byte-level vocabulary leaves whole: cut at blanks.

    Pieces come to it once each, so it keeps no cache.  None where the vocabulary cuts by another rule.
    """
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

    cut = tokenizer.pre_tokenizer
    if tokenizer.normalizer is not None or not isinstance(cut, ByteLevel) or not cut.use_regex or cut.add_prefix_space:
        return None
    letters = Tokenizer.from_file(vocabulary)
    letters.pre_tokenizer = Sequence([Split(" ", "merged_with_next"), ByteLevel(add_prefix_space=False, use_regex=False)])
    letters.model._resize_cache(0)
    return letters


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.entries = entries
        # Pieces at hand, their ids, and the number of the group that had each last.
        self.names, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.met, self.groups = np.zeros(0, np.int32), 0
        self.learnt: dict[str, bytes] = {}
        self.marks = {m: self.whole(m) for m in MARKS}
        self.letters = _letters(self.tokenizer, vocabulary)
        # Ids whose token begins with a blank or a line feed.
        spaces = tuple(_byte_letters()[b] for b in b" \n")
        vocabulary_ids = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary_ids.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary_ids.items() if token.startswith(spaces)]] = True

    def whole(self, text: str) -> bytes:
        return _ids(self.tokenizer.encode(text, add_special_tokens=False))

    def _learn(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of different pieces, but for those that can't stand alone.

        Pieces, without a final mark, are encoded as one text.  They have white space at their start only, so
        the ids of each begin at one that stands for it.
        """
        marked = [piece[-1:] in MARKS and piece[-2:-1].isalpha() for piece in pieces]
        bodies = [piece[:-1] if mark else piece for piece, mark in zip(pieces, marked)]
        new = dict.fromkeys(bodies)
        plain = [p for p in new if p.isalpha()] if self.letters else []
        joined = " ".join(plain)
        if not joined.isascii() and np.frombuffer(joined.encode("utf-32-le"), "<u4").max() >= LETTERS_END:
            plain = [p for p in plain if max(p) < chr(LETTERS_END)]
        if plain:
            self._split(self.letters, plain)
        if len(plain) < len(new):
            rest = [p for p in new if p not in self.learnt]
            alone = [p[1:] if p[:1] == "\n" else p for p in rest]
            if " ".join(alone).split() != alone:
                rest = [p for p, body in zip(rest, alone) if body.split() == [body]]
            self._split(self.tokenizer, rest)
        ids = list(map(self.learnt.get, bodies))
        self.learnt = {}
        return [i + self.marks[piece[-1]] if mark and i is not None else i for piece, mark, i in zip(pieces, marked, ids)]

    def _split(self, tokenizer, pieces: list[str]) -> None:
        """Encode pieces as one text and note the ids of each, unless pieces and white space differ in number."""
        joined = "".join([p if p[0] == "\n" else " " + p for p in pieces])
        ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        ends = [*(np.flatnonzero(self.opens[ids]) * 4).tolist(), len(ids) * 4]
        if len(ends) == len(pieces) + 1 and not ends[0]:
            ids = ids.tobytes()
            self.learnt.update(zip(pieces, [ids[a:b] for a, b in zip(ends, ends[1:])]))

    def texts(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of texts, in their order; those of a group are looked up, and their new pieces encoded, in one go."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP or len(group) >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        if group:
            yield from self._group(group)
        # Workers live on through stages that need no encoder.
        pa.default_memory_pool().release_unused()

    def _group(self, texts: list[str]) -> list[bytes]:
        # A piece starts with its line feed, or stands for one with a blank before it; only the first has neither.
        parts = pc.split_pattern(pa.array([text.replace("\n", " \n") for text in texts], pa.large_string()), " ")
        first, parts = parts.offsets.to_numpy()[:-1], parts.flatten()
        heads, others = parts.take(pa.array(first)).to_pylist(), np.ones(len(parts), bool)
        others[first] = False
        ends = np.append(first, len(parts)) - np.arange(len(texts) + 1)
        parts = parts.filter(pa.array(others))
        found = self._look_up(parts)
        ids, starts = found.buffers()[2], np.frombuffer(found.buffers()[1], "<i8")
        ids = memoryview(ids) if ids else b""
        lost = np.append(0, np.cumsum(found.is_null().to_numpy(zero_copy_only=False)))[ends]
        out = []
        for text, head, a, b, odd in zip(texts, heads, starts[ends[:-1]].tolist(), starts[ends[1:]].tolist(), (np.diff(lost) > 0).tolist()):
            if odd or head.split() != [head] * bool(head) or any(s in text for s in self.special):
                out.append(self.whole(text))
            else:
                out.append((self.whole(head) if head else b"") + ids[a:b])
        return out

    def _look_up(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces, null where one can't stand alone; of those that were met the latest are kept."""
        if not len(pieces):
            return self.ids.take(pa.array([], pa.int64()))
        known = len(self.names)
        # Pieces at hand come first in the dictionary, in their order.
        coded = pa.chunked_array([self.names, pieces]).dictionary_encode().chunks[-1]
        places, names = coded.indices, coded.dictionary
        new = (names.slice(at, TOGETHER).to_pylist() for at in range(known, len(names), TOGETHER))
        ids = pa.concat_arrays([self.ids, *[pa.array(self._learn(some), pa.large_binary()) for some in new]])
        met = np.append(self.met, np.zeros(len(names) - known, np.int32))
        self.groups += 1
        met[places.to_numpy()] = self.groups
        kept = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
        if len(kept) > self.entries:
            kept = np.sort(kept[np.argpartition(-met[kept], self.entries)[: self.entries]])
        self.names, self.ids, self.met = names, ids, met
        if len(kept) < len(names):
            self.names, self.ids, self.met = names.take(pa.array(kept)), ids.take(pa.array(kept)), met[kept]
        return ids.take(places)

    def text(self, text: str | None) -> bytes:
        """Ids of a text; a null text counts as empty."""
        return self._group([text or ""])[0]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(vocabulary: str, entries: int = CACHE_ENTRIES) -> Encoder:
    """The encoder of this worker process; Spark reuses workers, and so their caches."""
    if (vocabulary, entries) not in _ENCODERS:
        _ENCODERS[vocabulary, entries] = Encoder(vocabulary, entries)
    return _ENCODERS[vocabulary, entries]
