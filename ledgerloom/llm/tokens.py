"""Token ids of whole texts, with a word cache in front of a public tokenizer."""

from __future__ import annotations

import functools
import os
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerloom.llm import rolling

#: Units a task remembers before it forgets those that the last texts did not hold, some 40 bytes each.
CACHED_WORDS = 500_000
#: New units of letters encoded at a time.
TOGETHER = 1000
#: Bytes of text whose words are told apart at a time.
SLICE = 8 << 20
#: Kinds of bytes: white space, ASCII letters, ASCII punctuation but the apostrophe (which may be one with the letter
#: behind it), and all others.
SPACE, LETTER, MARK, OTHER = range(4)
KIND = np.full(256, OTHER, np.uint8)
KIND[rolling.IS_SPACE] = SPACE
KIND[list(string.ascii_letters.encode())] = LETTER
KIND[list(string.punctuation.replace("'", "").encode())] = MARK
#: Whether a unit starts at a byte, by the kinds of the byte before it and of itself (4 * before + itself).
WORD_START = np.array([b == SPACE != a for b in range(4) for a in range(4)])
UNIT_START = WORD_START | np.array([{b, a} == {LETTER, MARK} for b in range(4) for a in range(4)])
#: Characters that the plain steps may get wrong.
NOT_PLAIN = "[^\u0000-\u00ff]"
WHITE = " \t\n\x0b\x0c\r"


def default_tokenizer() -> str:
    """Path of the word-level BPE file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=1)
def shared_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a worker, which goes on with the words that earlier tasks met."""
    return WordTokenizer(path)


class WordTokenizer:
    """Ids of a tokenizer that never joins text across white space.

    Words between white space are encoded once and remembered while they keep coming.  New words of letters alone are
    encoded many at a time and told apart by the tokens that end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same vocabulary without the steps that leave lower-case Latin-1 letters as they are.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        if self.size > 1 << 16:
            raise ValueError("ids must fit in two bytes")
        self.ends = np.zeros(self.size, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self._remember(pa.array([""], pa.large_string()), self._lists([np.zeros(0, "<u2")]))

    def _remember(self, words: pa.Array, ids: pa.Array) -> None:
        self.words, self.ids = words, ids

    @staticmethod
    def _lists(ids: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
        return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, "<u2"), *ids])))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u2") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_letters(self, words: pa.Array) -> pa.Array:
        """Ids of words of letters, many at a time: the tokens that end a word tell them apart."""
        cuts = [*range(0, len(words), TOGETHER), len(words)]
        texts = [" ".join(words[a:b].to_pylist()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        ids = [np.array(e.ids, "<u2") for e in self.plain.encode_batch_fast([t.lower() for t in texts], add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, "<u2"), *ids])
        ends = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(ids))

    def _learned(self, new: pa.Array) -> tuple[pa.Array, pa.Array]:
        """New units in the order in which their ids are found."""
        plain = pc.and_(pc.utf8_is_alpha(new), pc.invert(pc.match_substring_regex(new, NOT_PLAIN)))
        letters, rest = new.filter(plain), new.filter(pc.invert(plain))
        return pa.concat_arrays([letters, rest]), pa.concat_arrays([self._encode_letters(letters), self._lists(self._encode(rest.to_pylist()))])

    @staticmethod
    def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes in lower case and starts of the units: words, cut once more between letters and marks, where a token always ends."""
        kind = KIND[data]
        before = np.empty_like(kind)
        before[:1] = SPACE
        before[1:] = kind[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = SPACE
        # Where a special token may stand in the text, words stay whole and as they are.
        special = b"<|" in data.tobytes()
        table = WORD_START if special else UNIT_START
        return data if special else rolling.LOWER[data], np.flatnonzero(table[before << 2 | kind])

    def _ids(self, words: pa.Array) -> pa.Array:
        """Two-byte ids of each of the words, as lists."""
        place = pc.index_in(words, self.words)
        if place.null_count:
            new = words.filter(pc.is_null(place)).unique()
            if len(self.words) + len(new) > CACHED_WORDS:  # words still in use stay, the others go
                used = place.drop_null().unique()
                self._remember(self.words.take(used), self.ids.take(used))
                place = pc.index_in(words, self.words)
            new, ids = self._learned(new)
            place = pc.coalesce(place, pc.add(pc.index_in(words, new), pa.scalar(len(self.words), pa.int32())))
            self._remember(pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, ids]))
        return self.ids.take(place)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """For each run of texts: the first one's place, and two-byte ids of each; null texts are empty.

        A run's bytes, cut at the starts of its units, are an Arrow array as they stand; its dictionary holds each
        distinct unit once, and its indexes spread their ids back over the texts.
        """
        data, offsets = rolling.text_bytes(texts)
        for a, b in rolling.chunks(offsets, SLICE):
            part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            part, starts = self._units(part, at)
            edges = np.concatenate([starts, [len(part)]]).astype(np.int64)
            units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(part))])
            coded = units.dictionary_encode()
            # A unit carries the white space behind it.
            words = pc.ascii_rtrim(coded.dictionary.cast(pa.large_string()), characters=WHITE)
            spread = self._ids(words).take(coded.indices)
            ids, stop = spread.flatten().to_numpy(), spread.offsets.to_numpy()
            stop = stop - stop[0]
            cut = stop[np.searchsorted(starts, at)].tolist()
            yield a, [ids[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Two-byte ids of each text."""
        return [ids for _, run in self.encode(pa.array(texts, pa.string())) for ids in run]
