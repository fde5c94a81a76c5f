"""Token ids of whole text columns: words are looked up once a slice, ids are gathered by numpy.

A text is cut at the six ASCII white-space characters, which end every token of the vocabularies
used here, so its ids are its words' ids in order.  ``WordTable`` keeps the ids of words already
seen, for as long as a Python worker lives.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa

from slotwise.llm import textnum

if TYPE_CHECKING:
    from tokenizers import Tokenizer

TABLE_WORDS = 800_000           # some 50 MB a worker more than half as many, and a third fewer words encoded again
SLICE_BYTES = 4 << 20
TOGETHER = 50
MARKS = ("~", "^", "|", "!")
#: Bytes of words: all but the six ASCII white-space characters.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[32, 9, 10, 11, 12, 13]] = False


class WordTable:
    """Words -> their ids in one flat array.  Beyond ``TABLE_WORDS`` words it goes on with those that more
    than one slice had, or anew if they are most of it."""

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]]):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)             # row k: ids[ends[k]:ends[k + 1]]
        self.slices = np.zeros(1 << 16, np.int32)           # how many slices had the word

    def _forget(self) -> None:
        again = np.flatnonzero(self.slices[:len(self.row)] > 1)
        words, ids, ends = list(self.row), self.ids, self.ends
        self._clear()
        if len(again) <= TABLE_WORDS // 2:
            self._keep([words[k] for k in again.tolist()], [ids[a:b] for a, b in zip(ends[again].tolist(), ends[again + 1].tolist(), strict=True)])

    def _add(self, words: list[str]) -> None:
        self._keep(words, self.encode(words))

    def _keep(self, words: list[str], new: Sequence[Sequence[int]]) -> None:
        self._keep_flat(words, np.array([i for x in new for i in x], np.uint32), np.array([len(x) for x in new], np.int64))

    def _keep_flat(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        """words with their ids in one array, so many each."""
        if not words:
            return
        first, used = len(self.row), int(self.ends[len(self.row)])
        ends = used + np.cumsum(sizes)
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.ends) <= first + len(words):
            self.ends, self.slices = (np.concatenate([x, np.zeros_like(x)]) for x in (self.ends, self.slices))
        self.ids[used:ends[-1]] = flat
        self.ends[first + 1:first + 1 + len(words)] = ends
        self.row.update(zip(words, range(first, first + len(words)), strict=True))

    def lookup(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids, and where each word's begin (one more for the end)."""
        coded = words.dictionary_encode()
        values = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in values if w not in self.row]
        if new and len(self.row) + len(new) > TABLE_WORDS:
            self._forget()
            new = [w for w in values if w not in self.row]
        if new:
            self._add(new)
        rows = np.fromiter(map(self.row.__getitem__, values), np.int64, len(values))
        self.slices[rows] += 1
        rows = rows[coded.indices.to_numpy(zero_copy_only=False)]
        begin, size = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        ends = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        return self.ids[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])], ends


def ids_of(column: pa.Array, table: WordTable, by_word: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, where each row's ids begin) for slices of a text column; nulls are
    empty.  Unless ``by_word``, whole texts go to the table."""
    for row, stop, buf, offsets in textnum.slices(column, SLICE_BYTES):
        if by_word:
            words, first = textnum.runs(buf, offsets, WORD_BYTES)
        else:
            words = pa.StringArray.from_buffers(stop - row, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(buf)))
            first = np.arange(stop - row + 1)
        ids, ends = table.lookup(words)
        yield row, stop, ids, ends[first]


class LibraryTable(WordTable):
    """A word table filled by the tokenizers library."""

    def __init__(self, path: str):
        # Spark runs a worker per core; threads of the library's own cost more than they save
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        super().__init__(lambda words: [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)])
        self.bare, self.special = self._without_normalizer(path)
        self.mark, self.mark_id = next(((m, i) for m in MARKS if (i := self._alone(m)) is not None), ("", -1))

    @staticmethod
    def _without_normalizer(path: str) -> tuple[Tokenizer | None, re.Pattern]:
        """The file's tokenizer for text that is normalized already, if all its normalizer does to printable
        ASCII words is to lower-case them; and where an added token (matched before normalizing) may begin."""
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec.get("normalizer") or {}).get("normalizers", ())
        first = {c for t in spec["added_tokens"] for c in (t["content"][0].lower(), t["content"][0].upper())}
        special = re.compile("|".join(map(re.escape, sorted(first))) or r"(?!)")
        if [x["type"] for x in steps] != ["NFC", "Replace", "Lowercase"] or (steps[1]["pattern"], steps[1]["content"]) != ({"Regex": r"\s+"}, " "):
            return None, special
        bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None}))
        bare.no_truncation()
        bare.no_padding()
        return bare, special

    def _alone(self, mark: str) -> int | None:
        """The id of a word that is one known token and leaves its neighbours as they are; else None."""
        a, m, b, all_ = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in ("ab1", mark, "c.d", f"ab1 {mark} c.d"))
        return m[0] if len(m) == 1 and all_ == a + m + b and mark in self.tokenizer.id_to_token(m[0]) else None

    def _add(self, words: list[str]) -> None:
        """Words that hold the mark are encoded one by one, others together; printable ASCII words without a
        beginning of an added token need only be lower-cased, so they pass the normalizer by."""
        alone: list[str] = []
        plain: list[str] = []
        other: list[str] = []
        for w in words:
            if not self.mark or self.mark in w:
                alone.append(w)
            elif self.bare and w.isascii() and w.isprintable() and not self.special.search(w):
                plain.append(w)
            else:
                other.append(w)
        for tokenizer, some, change in ((self.bare, plain, str.lower), (self.tokenizer, other, str)):
            if some and not self._together(tokenizer, some, change):
                alone += some
        if alone:
            super()._add(alone)

    def _together(self, tokenizer: Tokenizer, words: list[str], change: Callable[[str], str]) -> bool:
        """New words are encoded ``TOGETHER`` at a time, a word that none of them holds between them; its id
        then stands between theirs.  False if some word's normal form holds it."""
        ids: list[int] = []
        between = f" {self.mark} "
        for e in tokenizer.encode_batch_fast([change(between.join(words[k:k + TOGETHER])) for k in range(0, len(words), TOGETHER)], add_special_tokens=False):
            ids += e.ids
            ids.append(self.mark_id)
        flat = np.array(ids, np.int64)
        cuts = np.flatnonzero(flat == self.mark_id)
        if len(cuts) != len(words):
            return False
        self._keep_flat(words, flat[flat != self.mark_id], np.diff(cuts, prepend=-1) - 1)
        return True

    def of(self, text: str) -> bytes:
        """One text's ids (little-endian uint32 bytes)."""
        return b"".join(ids.astype("<u4").tobytes() for _, _, ids, _ in ids_of(pa.array([text]), self))


_tables: dict[str, LibraryTable] = {}


def cached(path: str) -> LibraryTable:
    """This worker's table for a tokenizer file."""
    if path not in _tables:
        _tables[path] = LibraryTable(path)
    return _tables[path]
