"""Token ids of whole texts, with a memory of the pieces between blanks.

No token of the word tokenizer reaches over a blank or line feed, and none depends on what lies beyond, so a text is cut
there and each distinct piece is encoded once per worker. Punctuation behind a word is a token of its own and the tokenizer lowers
its input, so a piece is put together from two parts, its stem and what follows, and only parts are remembered. The unknown parts of
many texts are encoded in one call, words of letters alone as running text that is cut behind the tokens that end a word. A full memory
keeps the parts of the newest texts, hence the frequent ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.worker import kept

KEPT_PARTS = 500_000
CALL_PARTS = 8192
LINE_PARTS = 256
BATCH_CHARS = 4 << 20
# Characters that may follow a word. No apostrophe: it may begin a contraction.
PUNCTUATION = "!\"#$%&()*+,-./:;=?@[\\]^_{|}~"


def split_piece(piece: str) -> tuple[str, str]:
    """The stem in lower case and the punctuation behind it, where the ids of both make up those of the piece."""
    stem = piece.rstrip(PUNCTUATION)
    # The last letter must stay one: some end in a mark when they are composed or lowered, and a mark joins the punctuation.
    if not stem or "<" in piece or not normalize("NFC", stem[-1]).lower()[-1].isalpha():
        stem = piece
    return (stem.lower() if stem.isascii() and "<" not in stem else stem), piece[len(stem):]


def split_pieces(pieces: pa.StringArray) -> pa.Array:
    """The two parts of each piece in turn, as ``split_piece`` has them; only stems that end in no ASCII letter are looked at singly."""
    _, offsets, data = pieces.buffers()
    offsets = np.frombuffer(offsets, np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
    begin, end = offsets[:-1], offsets[1:]
    stem = np.asarray(pc.binary_length(pc.ascii_rtrim(pieces, PUNCTUATION)))
    open_ = (stem > 0) & (begin + stem < end) & ~np.asarray(pc.match_substring(pieces, "<"))
    rows = np.flatnonzero(open_)
    last = np.frombuffer(data or b"", np.uint8)[begin[rows] + stem[rows] - 1]
    cut = end.copy()
    letter = ((last | 32) >= ord("a")) & ((last | 32) <= ord("z"))
    cut[rows[letter]] = (begin + stem)[rows[letter]]
    for row in rows[last >= 128].tolist():
        cut[row] -= len(split_piece(pieces[row].as_py())[1])
    bounds = np.empty(2 * len(pieces) + 1, np.int32)
    bounds[0::2], bounds[1::2] = offsets, cut
    parts = pa.StringArray.from_buffers(2 * len(pieces), pa.py_buffer(bounds), data)
    low = pc.and_not(pc.string_is_ascii(parts), pc.match_substring(parts, "<"))
    return pc.if_else(low, pc.ascii_lower(parts), parts)


class Encoder:
    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        vocabulary, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def call(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and the number of each."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), "<u4", int(counts.sum())), counts

    def ids_of(self, parts: list[str], words: bool = False) -> Iterator[bytes]:
        """The ids of each part, little-endian unsigned 32-bit; a call of the tokenizer per ``CALL_PARTS``, as its results are large.

        ``words`` are of letters alone, so each gives one word of the tokenizer, or more where a letter is composed of others. If the
        ends of words are as many as the parts, each part is one word.
        """
        for at in range(0, len(parts), CALL_PARTS):
            some = parts[at : at + CALL_PARTS]
            if words:
                ids, _ = self.call([" ".join(some[i : i + LINE_PARTS]) for i in range(0, len(some), LINE_PARTS)])
                ends = np.flatnonzero(self.ends_word[ids]) + 1
            if not words or len(ends) != len(some):
                ids, counts = self.call(some)
                ends = np.cumsum(counts)
            data, ends = ids.tobytes(), (4 * ends).tolist()
            yield from (data[a:b] for a, b in zip([0, *ends], ends))

    def learn(self, parts: list[str]) -> None:
        words = [p for p in parts if p.lower().isalpha()]
        others = [p for p in parts if not p.lower().isalpha()]
        self.known.update(zip(words, self.ids_of(words, words=True), strict=True))
        self.known.update(zip(others, self.ids_of(others), strict=True))

    def encode_group(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; all parts that are not known yet are encoded together."""
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        pieces = cut.flatten().dictionary_encode()
        parts = split_pieces(pieces.dictionary.cast(pa.string())).dictionary_encode()
        names = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn([p for p in names if p not in self.known])
        found = [self.known[p] for p in names]
        of_parts = pa.array(found, pa.large_binary()).take(parts.indices)
        _, bounds, data = of_parts.buffers()
        bounds = np.frombuffer(bounds, np.int64)[: len(of_parts) + 1 : 2].copy()
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(pieces.dictionary), [None, pa.py_buffer(bounds), data]).take(pieces.indices)
        _, bounds, data = ids.buffers()
        bounds = np.frombuffer(bounds, np.int64)[np.asarray(cut.offsets) - cut.offsets[0].as_py()].tolist()
        if len(self.known) > KEPT_PARTS:
            self.known = dict(zip(names, found, strict=True))
        data = memoryview(data or b"")
        for a, b in zip(bounds, bounds[1:]):
            yield bytes(data[a:b])

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text in turn; texts are encoded in groups of about ``BATCH_CHARS`` bytes."""
        ends = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
        at = 0
        while at < len(texts):
            until = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_CHARS, side="right"))
            until = max(until, at + 1)
            yield from self.encode_group(texts.slice(at, until - at))
            at = until

    def encode(self, text: str) -> bytes:
        return next(self.encode_group(pa.array([text], pa.string())))


def encoder(path: str) -> Encoder:
    return kept(f"encoder:{path}", lambda: Encoder(path))
