"""Token ids of whole texts by way of their distinct words.

White space never lies inside a token of these vocabularies except before a
word, so the ids of a text are those of its words in a row. Arrow cuts a slice
of texts into words and numbers the distinct ones; only those are cut further
into pieces. A worker keeps bounded tables of pieces, and of words of unusual
signs; the tokenizer runs once per entry. Texts whose white space is not plain
are cut one by one.
"""

from __future__ import annotations

import gc
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from tokenizers import Tokenizer, pre_tokenizers

from millrace.llm.batches import ragged

#: Pieces and words kept by a worker; the tables start anew beyond it.
KEPT_WORDS = 1_200_000

#: Text bytes that are cut into words at once.
ENCODED_BYTES = 4 << 20

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: White space other than a blank and a line end, as Arrow's expressions write it.
_UNPLAIN = r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_CHUNK = re.compile(rb"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b], extra = chr(extra), extra + 1
    return out


_BYTE_LETTERS = _byte_letters()


class _Table:
    """Ids of numbered words, side by side.

    Words are found by a 128-bit hash in sorted arrays, so an entry takes some
    tens of bytes, not an object each.
    """

    def __init__(self):
        self.high, self.low, self.number = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[str] = []

    def __len__(self):
        return len(self.number)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of some distinct words, in the order in which they first came; ``new`` has those without ids yet."""
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").reshape(-1, 2).astype(np.uint64)
        out = np.full(len(words), -1, np.int64)
        at = np.searchsorted(self.high, hashes[:, 0])
        inside = np.flatnonzero(at < len(self.high))
        hit = inside[(self.high[at[inside]] == hashes[inside, 0]) & (self.low[at[inside]] == hashes[inside, 1])]
        out[hit] = self.number[at[hit]]
        fresh = np.flatnonzero(out < 0)
        out[fresh] = len(self.number) + np.arange(len(fresh))
        if len(fresh):
            self.new = [words[i] for i in fresh.tolist()]
            order = fresh[np.argsort(hashes[fresh, 0], kind="stable")]
            places = at[order]
            self.high, self.low = (np.insert(old, places, hashes[order, k]) for k, old in enumerate((self.high, self.low)))
            self.number = np.insert(self.number, places, out[order])
        return out

    def add(self, ids: np.ndarray, lengths: np.ndarray):
        """Ids of the new words, in order."""
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        self.new = []

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered words in a row, and how many each has."""
        lengths = self.lengths[numbers]
        return self.ids[ragged(self.starts[numbers], lengths)], lengths


class TextIds:
    """Ids of texts for a vocabulary file of the tokenizers library.

    ``spaces``: the white space before a word is part of its tokens; else it is
    dropped by the vocabulary's own normaliser.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        self.bare = Tokenizer(self.full.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.spaces = self.full.normalizer is None
        self.kept = kept
        # Words of other letters or signs go through the whole tokenizer.
        self.hard = rf"[^{_LETTERS}0-9!-&(-/:-@\[-`{{-~]|<\|"
        if self.spaces:
            self.hard = rf"^\n?(?:$|.*(?:{self.hard}))"
            self.pieces = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\n|\t").findall
        else:
            self.pieces = re.compile(rf"[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+|\t").findall
        self._reset()

    def _reset(self):
        self.known, self.odd = _Table(), _Table()

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, list[str]]:
        """Texts as numbers of their words in a row, and how many each has; the distinct words, which of them are used, and further texts.

        A distinct word has one blank before it, or the line end that it begins
        with, where white space counts. The further texts, numbered behind the
        words, stand for themselves.
        """
        if not self.spaces:
            lists = pc.ascii_split_whitespace(texts)
            coded = lists.flatten().dictionary_encode()
            return coded.indices.to_numpy(), np.diff(lists.offsets.to_numpy()), coded.dictionary, np.ones(len(coded.dictionary), bool), []
        lists = pc.split_pattern(pc.replace_substring(texts, pattern="\n", replacement=" \n"), pattern=" ")
        coded, ends = lists.flatten().dictionary_encode(), lists.offsets.to_numpy().astype(np.int64)
        values, numbers, counts = coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.diff(ends)
        # Several blanks or line ends in a row show as empty words or bare line ends.
        bare = np.asarray(pc.is_in(values, pa.array(["", "\n"], values.type)))
        empty = np.asarray(pc.binary_length(texts)) == 0
        odd = np.logical_or.reduceat(bare[numbers], ends[:-1]) | np.asarray(pc.match_substring_regex(texts, _UNPLAIN)) | empty
        plain = np.repeat(~odd, counts)
        firsts = ends[:-1][~odd]
        plain[firsts] = False
        used = np.zeros(len(values), bool)
        used[numbers[plain]] = True
        opening, back = np.unique(numbers[firsts], return_inverse=True)
        further = {values[i].as_py(): len(values) + k for k, i in enumerate(opening.tolist())}
        numbers[firsts] = len(values) + back
        if odd.any():
            rows, at = [], 0
            for i in np.flatnonzero(odd).tolist():
                rows.append(numbers[at : ends[i]])
                own = [c.decode() for c in self._chunks(texts[i].as_py().encode())]
                for c in own:
                    further.setdefault(c, len(values) + len(further))
                rows.append(np.array([further[c] for c in own], np.int64))
                at, counts[i] = ends[i + 1], len(own)
            numbers = np.concatenate([*rows, numbers[at:]])
        return numbers, counts, values, used, list(further)

    def _chunks(self, text: bytes) -> list[bytes]:
        if not text or _ODD_SPACE.search(text):
            return [text] if text else []
        return _CHUNK.findall(text)

    def _word_ids(self, values: pa.Array, used: np.ndarray, further: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids side by side, and where those of each word and each further text begin and how many they are."""
        hard = np.asarray(pc.match_substring_regex(values, self.hard)) | (np.asarray(pc.binary_length(values)) == 0)
        lengths = np.zeros(len(values) + len(further), np.int64)
        soft = np.flatnonzero(used & ~hard)
        ids = np.zeros(0, np.int32)
        if len(soft):
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(soft)], values.take(pa.array(soft))), "\t")[0].as_py()
            text = (" " + text.replace("\t", "\t ")).replace(" \n", "\n") if self.spaces else text.lower()
            coded = pa.array(self.pieces(text + "\t"), pa.string()).dictionary_encode()
            distinct, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            numbers = self.known.numbers(distinct)[at]
            self._learn_pieces()
            ids, each = self.known.gather(numbers)
            upto = np.concatenate([[0], np.cumsum(each)])
            lengths[soft] = np.diff(upto[np.flatnonzero(at == distinct.index("\t"))], prepend=0)
        rest = np.flatnonzero(used & hard)
        texts = values.take(pa.array(rest)).to_pylist()
        if self.spaces:
            texts = [w if w[:1] == "\n" else " " + w for w in texts]
        distinct = list(dict.fromkeys(texts + further))
        of = dict(zip(distinct, self.odd.numbers(distinct).tolist()))
        if new := self.odd.new:
            got = [np.asarray(x.ids, np.int32) for x in self.full.encode_batch_fast(new, add_special_tokens=False)]
            self.odd.add(np.concatenate(got), np.array([len(x) for x in got], np.int64))
        more, each = self.odd.gather(np.fromiter((of[t] for t in texts + further), np.int64, len(texts) + len(further)))
        rest = np.concatenate([rest, np.arange(len(values), len(lengths))])
        lengths[rest] = each
        order = np.concatenate([soft, rest])
        starts = np.zeros(len(lengths), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return np.concatenate([ids, more]), starts, lengths

    def _learn_pieces(self):
        """Ids of the pieces numbered since the last call; the mark between words has none."""
        new = self.known.new
        if not new:
            return
        real = np.array([w != "\t" for w in new])
        got = self.bare.encode("\t".join(new).encode().decode("latin-1").translate(_MAP), add_special_tokens=False)
        lengths = np.zeros(len(new), np.int64)
        lengths[real] = np.bincount(np.asarray(got.word_ids, np.int64), minlength=int(real.sum()))
        self.known.add(np.asarray(got.ids, np.int32), lengths)

    def encode(self, texts: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has; nulls are empty."""
        if len(self.known) + len(self.odd) > self.kept:
            self._reset()
        column = pa.array(texts, pa.binary()).cast(pa.string()) if isinstance(texts, list) else texts
        if not len(column):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        # Millions of small objects that hold no cycles: the collector would only walk over them.
        collecting = gc.isenabled()
        gc.disable()
        try:
            words, counts, values, used, further = self._cut(pc.fill_null(column, ""))
            ids, starts, lengths = self._word_ids(values, used, further)
        finally:
            if collecting:
                gc.enable()
        each = lengths[words]
        ends, cuts = (np.concatenate([[0], np.cumsum(x)]) for x in (each, counts))
        return ids[ragged(starts[words], each)], np.diff(ends[cuts])


#: Byte letters for a text read as latin-1; the tab between pieces stays white space.
_MAP = {b: c for b, c in _BYTE_LETTERS.items() if b != 9}

_LOADED: dict[str, TextIds] = {}


def text_ids(path: str) -> TextIds:
    """The worker's table for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = TextIds(path)
    return _LOADED[path]
