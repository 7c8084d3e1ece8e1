"""Token ids of texts by a public tokenizer, with the ids of repeated words looked up."""

from __future__ import annotations

import os
import string
import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle

from tallyflow.llm import spans

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "word_bpe_49k.json"
#: A run of these after letters is a unit of its own to this tokenizer.
MARKS = string.punctuation
END = "</w>"
#: Bytes of texts that are encoded at a time.
SLICE_BYTES = 1 << 20


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def grown(array: np.ndarray, need: int) -> np.ndarray:
    return array if need <= len(array) else np.concatenate([array, np.zeros(max(need, len(array)), array.dtype)])


def gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The values at [begin, begin + size) of each entry, in a row."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begin - (ends - size), size) + np.arange(total)]


class CachedEncoder:
    """Encodes texts piece by piece, where pieces are what stands between white space.

    This tokenizer lower-cases, turns all white space into one blank and drops it, and nothing in
    it looks across a blank, so the ids of a text are those of its pieces in a row. Ids of pieces
    are kept between texts in arrays sorted by 64-bit digests, up to ``most`` pieces; then the
    store begins anew. So memory is bounded, and two of a million pieces fall together once in 10**7 stores.
    """

    def __init__(self, path: str | None = None, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads cost memory as well
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_path())
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values()) + 1 + 64, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(END)]] = True
        self.most = most
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def _store(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = grown(self.ids, self.used + len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        begin = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        every = np.concatenate([self.keys, keys])
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.size = np.concatenate([self.size, sizes])[order]

    def _each(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def _together(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of letters alone: each is one word to the tokenizer, and ends with a last token."""
        parts = [pieces[at : at + 256] for at in range(0, len(pieces), 256)]
        texts = [b" ".join(p).decode() for p in parts]
        ids, sizes = [], []
        for part, found in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            got = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self.last[got]) + 1
            counts = np.diff(ends, prepend=0)
            if len(ends) != len(part) or (len(ends) and ends[-1] != len(got)):  # letters of another Unicode version
                got, counts = self._each(part)
            ids.append(got)
            sizes.append(counts)
        none = np.zeros(0, np.int64)
        return np.concatenate([none.astype(np.uint32), *ids]), np.concatenate([none, *sizes])

    def _learn(self, pieces: Sequence[bytes]) -> None:
        """Stores new pieces: letters alone, letters with a tail of marks, and others."""
        letters, other, marked, whole = {}, {}, [], []
        for piece in pieces:
            text = piece.decode()
            if text.isalpha():
                letters[piece] = None
            elif (stem := text.rstrip(MARKS)) and stem.isalpha():
                cut = len(stem.encode())
                marked += [piece[:cut], piece[cut:]]
                whole.append(piece)
            else:
                other[piece] = None
        if marked:
            _, known = self._find(piece_digests(marked))
            letters |= {p: None for p, k in zip(marked[::2], known[::2], strict=True) if not k}
            other |= {p: None for p, k in zip(marked[1::2], known[1::2], strict=True) if not k}
        for new, encode in ((list(letters), self._together), (list(other), self._each)):
            if new:
                self._store(piece_digests(new), *encode(new))
        if whole:
            at, _ = self._find(piece_digests(marked))
            size = self.size[at]
            self._store(piece_digests(whole), gathered(self.ids, self.begin[at], size), size[::2] + size[1::2])

    def encode_all(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (as ``spans.flat`` gives them) in a row, and where each text begins.

        Equal pieces are found by their digests, then each different piece is looked up once.
        """
        data = spans.LOWER[data]
        starts, ends, ranges = spans.word_spans(data, offsets)
        keys, first, which = np.unique(spans.SpanDigests(data)(starts, ends), return_index=True, return_inverse=True)
        _, known = self._find(keys)
        if not known.all():
            if len(self.keys) + 2 * int((~known).sum()) > self.most:
                self._reset()
                known[:] = False
            body, first = data.tobytes(), first[~known]
            self._learn([body[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        at, _ = self._find(keys)
        at = at[which]
        size = self.size[at] if len(at) else np.zeros(0, np.int64)
        before = np.concatenate([[0], np.cumsum(size)])
        return gathered(self.ids, self.begin[at] if len(at) else size, size), before[ranges]


def piece_digests(pieces: Sequence[bytes]) -> np.ndarray:
    ends = np.cumsum([len(p) for p in pieces])
    starts = np.concatenate([[0], ends[:-1]])
    return spans.SpanDigests(np.frombuffer(b"".join(pieces), np.uint8))(starts, ends)
