"""Tokenizer files as they are used inside tasks: opened once per worker, with bounded caches."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from passagemill.llm.common import worker_state

#: Entries of each generation of a worker's cache.
CACHE_ENTRIES = 300_000

#: Longer pieces are encoded each time and never cached.
CACHED_CHARS = 64

#: Stems that are encoded by one call, whose tokens take far more memory than their ids.
STEMS_AT_ONCE = 2_000

#: Long texts are cut between words into segments of about this many signs.
SEGMENT_CHARS = 1 << 20

_BETWEEN = re.compile(r"(?<=[^ \t\n\r\x0b\x0c]) (?=[^ \t\n\r\x0b\x0c])")


def tokenizer_path(name: str) -> str:
    """A file's path: ``name`` itself if it is a path, else the installed public file."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def open_tokenizer(name: str):
    """The worker's tokenizer for ``name``, opened at its first use."""
    opened = worker_state("tokenizers")
    if name not in opened:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path(name))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        opened[name] = tokenizer
    return opened[name]


#: Plain words: Latin letters, then ASCII punctuation but for the apostrophe. Each of the two is one
#: pre-token, and both are their own composed form.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
_LOWER = _UPPER.lower() + "ßÿ"
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_STEM = re.compile(f"[{_LOWER}]+")
_TRIED = ("the", "été", "straßenbahn", "ñandú", "qzxvkj", "ÿ", "x" * 99, _LOWER)
_TRIED_WHOLE = ("The", "Été", "the,", "was###", "é...", "$$%_", "A<|", f"{_UPPER}{_LOWER}{_SIGNS}")


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others for signs from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _whole(tokenizer, pieces: list[str]) -> list[bytes]:
    return [_packed(one.ids) for one in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


def _direct(tokenizer) -> Callable[[list[str]], list[bytes]] | None:
    """Ids of lower-case stems straight from the merges, many in one call, without the steps before them
    that change nothing in a stem. Their ends are found by the suffix of a word's last token. None unless
    trial words show that the tokenizer is of this kind and that a plain word's ids are those of its
    stem and of its signs."""
    from tokenizers import Tokenizer, pre_tokenizers

    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    vocabulary = tokenizer.get_vocab()
    last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    last[[at for token, at in vocabulary.items() if token.endswith(suffix)]] = True
    merges = Tokenizer(tokenizer.model)
    merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    signs = _byte_signs()
    spelled = {sign: "".join([signs[byte] for byte in sign.encode()]) for sign in _LOWER if not sign.isascii()}

    def ids(stems: list[str]) -> list[bytes]:
        calls = range(0, len(stems), STEMS_AT_ONCE)
        return list(chain.from_iterable(called(stems[begin : begin + STEMS_AT_ONCE]) for begin in calls))

    def called(stems: list[str]) -> list[bytes]:
        text = " ".join(stems)
        if not text.isascii():
            # no sign that one of these puts in is put in place of by another
            for sign, bytes_ in spelled.items():
                text = text.replace(sign, bytes_)
        found = np.array(merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (4 * (np.flatnonzero(last[found]) + 1)).tolist()
        if len(ends) != len(stems):
            return _whole(tokenizer, stems)
        packed = found.tobytes()
        return [packed[begin:end] for begin, end in zip([0, *ends[:-1]], ends, strict=True)]

    same = ids(list(_TRIED)) == _whole(tokenizer, list(_TRIED))
    if same:
        rows = pa.array(_TRIED_WHOLE)
        stems, tails = (column.to_pylist() for column in _parts(rows))
        parts = [first + second for first, second in zip(ids(stems), _whole(tokenizer, tails), strict=True)]
        same = parts == _whole(tokenizer, list(_TRIED_WHOLE))
    return ids if same else None


def _parts(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Lower-case stem and signs of each plain word; any other word whole, and nothing after it."""
    stems = pc.utf8_rtrim(words, characters=_SIGNS)
    plain = pc.equal(pc.binary_length(pc.utf8_ltrim(stems, characters=_UPPER + _LOWER)), 0)
    tails = pc.utf8_ltrim(words, characters=_UPPER + _LOWER)
    return pc.if_else(plain, pc.utf8_lower(stems), words), pc.if_else(plain, tails, "")


def _opened_direct(name: str):
    known = worker_state("direct_ids")
    if name not in known:
        known[name] = _direct(open_tokenizer(name))
    return known[name]


def split_words(words: pa.Array, name: str) -> tuple[pa.Array, pa.Array]:
    """Two pieces of each word, whose ids one after the other are the word's: its stem and its signs,
    where this tokenizer keeps them apart, else the word and nothing."""
    if _opened_direct(name):
        return _parts(words)
    return words, pa.array([""] * len(words), words.type)


def packed_ids(pieces: list[str], name: str) -> list[bytes]:
    """The ids of each piece on its own, without special tokens around it, as little-endian unsigned
    32-bit numbers."""
    tokenizer, direct = open_tokenizer(name), _opened_direct(name)
    if direct is None:
        return _whole(tokenizer, pieces)
    stem = [_STEM.fullmatch(piece) is not None for piece in pieces]
    short = iter(direct([piece for piece, found in zip(pieces, stem, strict=True) if found]))
    others = iter(_whole(tokenizer, [piece for piece, found in zip(pieces, stem, strict=True) if not found]))
    return [next(short if found else others) for found in stem]


def encode_pieces(pieces: list[str], name: str) -> list[list[int]]:
    """The ids of each piece on its own, without special tokens around it."""
    return [np.frombuffer(one, dtype="<u4").tolist() for one in packed_ids(pieces, name)]


def segments(text: str) -> Iterable[str]:
    """``text`` cut before single spaces between two words, where no pre-token can lie across."""
    begin = 0
    while len(text) - begin > SEGMENT_CHARS:
        found = _BETWEEN.search(text, begin + SEGMENT_CHARS)
        if found is None:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:] if begin else text


class PieceCache(dict):
    """What each piece is encoded to, filled for whole batches of missing pieces.

    When it is full, its entries become the older generation; those that are met again come back from
    there, so that frequent pieces stay and rare ones go. Pieces of more than ``CACHED_CHARS`` are held for
    the present batch only, so a generation has at most ``entries`` short entries, or those of one batch.
    """

    def __init__(self, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.entries = entries
        self.older: dict = {}
        self.long: dict = {}

    def __missing__(self, piece):
        return self.long[piece]

    def fill(self, pieces: set, encode: Callable[[list], Iterable]) -> None:
        missing = [piece for piece in pieces if piece not in self]
        long = [piece for piece in missing if len(piece) > CACHED_CHARS]
        self.long = dict(zip(long, encode(long), strict=True)) if long else {}
        if len(self) + len(missing) > self.entries:
            self.older = dict(self)
            self.clear()
            missing = list(pieces)
        if long:
            missing = [piece for piece in missing if piece not in self.long]
        older = self.older
        self.update((piece, older[piece]) for piece in missing if piece in older)
        unknown = [piece for piece in missing if piece not in older]
        self.update(zip(unknown, encode(unknown), strict=True))


def batches_of(texts: list[str], limit: int = 1 << 22) -> Iterable[tuple[int, int]]:
    """Bounds of runs of texts with about ``limit`` signs each."""
    begin = size = 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield begin, at + 1
            begin, size = at + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
