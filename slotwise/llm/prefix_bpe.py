"""BPE encoding by dynamic programming over prefixes, and decoding.

Merging pairs by rank gives a text one encoding, and two neighbouring tokens of it stay apart
because no merge ever joins the right edge of the first to the left edge of the second.  So a
sequence of tokens is the encoding exactly if every neighbouring pair is *compatible* in that sense,
and every prefix has one last token: the one suffix of it that is a token and is compatible with the
last token of what stands before.  An Aho-Corasick automaton over the vocabulary (suffix links: from
a token to the next shorter one that ends there) lists the suffixes of every prefix; the last
tokens are kept per prefix and followed back from the end.  The work is linear in the text for a
given vocabulary, however long a word is; nothing is merged.

Words' ids are kept in a table per worker, so a word is worked on once, not at every place.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import word_ids
from slotwise.llm.common import arrow_map

#: Stands for a vocabulary's end-of-word suffix inside the automaton; no byte-level character.
_END = "\n"
_MEMO = 1 << 20
_NEVER = 1 << 62


class PrefixBpe:
    """A tokenizer file's encoding.  Normalizing and splitting into words are the tokenizers library's,
    from the same file; the encoding of words is this module's."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("a BPE vocabulary without prefixes, dropout or ignored merges is needed")
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str if library.normalizer else lambda text: text
        self.split = library.pre_tokenizer.pre_tokenize_str
        #: white space never reaches a token, so texts may be cut at it
        self.by_word = [w for w, _ in self.split(self.normalize("a b\tc\nd"))] == ["a", "b", "c", "d"]
        self.ascii_split = _ascii_split(spec) if self.by_word else None
        self.decoder = (spec.get("decoder") or {}).get("type")
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.end = _END if suffix else ""
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = added
        self.outside = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.tokens = self._names(vocabulary | added)
        spelled = {i: t for t, i in vocabulary.items() if len(t) == 1}
        if suffix:
            spelled |= {i: t[0] + _END for t, i in vocabulary.items() if len(t) == 1 + len(suffix) and t[1:] == suffix}
        self.rank: dict[int, int] = {}                              # left << 32 | right
        self.halves: dict[int, tuple[int, int, int]] = {}            # token -> left, right, rank
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if whole in spelled or a not in spelled or b not in spelled:
                raise ValueError(f"merge {rank} makes a token twice, or before its parts")
            self.rank[a << 32 | b], self.halves[whole], spelled[whole] = rank, (a, b, rank), spelled[a] + spelled[b]
        self.length = {i: len(t) for i, t in spelled.items()}
        self._automaton(spelled)
        self._right: dict[int, list[tuple[int, int, int]]] = {}
        self._left: dict[int, list[tuple[int, int, int]]] = {}
        self._compatible: dict[int, bool] = {}
        self.words = word_ids.WordTable(self.encode_many)

    @staticmethod
    def _names(ids: dict[str, int]) -> pa.StringArray:
        names = [""] * (max(ids.values()) + 1)
        for t, i in ids.items():
            names[i] = t
        return pa.array(names, pa.string())

    def _automaton(self, spelled: dict[int, str]) -> None:
        """Nodes are the beginnings of tokens: ``step`` goes on by a character, ``fail`` to the longest
        proper suffix that is a node, ``longest`` is the longest token that ends there, and
        ``shorter`` the next one that ends with a token."""
        self.step: list[dict[str, int]] = [{}]
        self.longest, own = [-1], [-1]
        for token, text in spelled.items():
            node = 0
            for c in text:
                if c not in self.step[node]:
                    self.step[node][c] = len(self.step)
                    self.step.append({})
                    own.append(-1)
                node = self.step[node][c]
            own[node] = token
        self.fail, self.longest = [0] * len(self.step), list(own)
        self.shorter: dict[int, int] = {}
        level = list(self.step[0].values())
        while level:
            for node in level:
                below = self.longest[self.fail[node]]
                if own[node] >= 0:
                    self.shorter[own[node]] = below
                else:
                    self.longest[node] = below
                for c, child in self.step[node].items():
                    self.fail[child] = self._next(self.fail[node], c)
            level = [child for node in level for child in self.step[node].values()]

    def _next(self, node: int, c: str) -> int:
        while c not in self.step[node]:
            if not node:
                return 0
            node = self.fail[node]
        return self.step[node][c]

    def _edge(self, token: int, side: int, known: dict[int, list[tuple[int, int, int]]]) -> list[tuple[int, int, int]]:
        """The tokens that stand at one edge of ``token`` while it is built, from the last to the first,
        each with the rank of the merge that takes it in and of the one that made it (-1: none)."""
        if token not in known:
            edge, taken, at = [], _NEVER, token
            while at >= 0:
                half = self.halves.get(at)
                made = half[2] if half else -1
                edge.append((at, taken, made))
                at, taken = half[side] if half else -1, made
            known[token] = edge
        return known[token]

    def compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b``, side by side, are the encoding of their joined text.

        A merge of edge tokens x and y happens unless one of them is taken in before; of equal ranks
        the one further left goes first.  Going back in time, the edge token made last is undone
        first, so every pair that stands side by side at some time is seen once.
        """
        at = a << 32 | b
        known = self._compatible.get(at)
        if known is None:
            left, right = self._edge(a, 1, self._right), self._edge(b, 0, self._left)
            (x, x_taken, x_made), (y, y_taken, y_made) = left[0], right[0]
            i = j = 0
            known = True
            while known:
                rank = self.rank.get(x << 32 | y, _NEVER)
                if rank < x_taken and rank <= y_taken:
                    known = False
                elif y_made >= x_made and y_made >= 0:
                    j += 1
                    y, y_taken, y_made = right[j]
                elif x_made >= 0:
                    i += 1
                    x, x_taken, x_made = left[i]
                else:
                    break
            if len(self._compatible) >= _MEMO:
                self._compatible.clear()
            self._compatible[at] = known
        return known

    def _pieces(self, pieces: list[str]) -> dict[str, list[int]]:
        """Ids of distinct words (byte-level characters).  In sorted order a word's prefixes are often those
        of the word before, whose last tokens still hold."""
        step, longest, length, shorter, memo = self.step, self.longest, self.length, self.shorter, self._compatible
        found: dict[str, list[int]] = {}
        last: list[int] = []                             # of the prefix that ends at each place
        nodes: list[int] = []
        text = ""
        for piece in sorted(pieces):
            before, text = text, piece + self.end
            same = 0
            for x, y in zip(before, text):
                if x != y:
                    break
                same += 1
            del last[same:], nodes[same:]
            node = nodes[-1] if nodes else 0
            for place in range(same, len(text)):
                c = text[place]
                node = step[node][c] if c in step[node] else self._next(node, c)
                nodes.append(node)
                token = longest[node]
                while token >= 0:
                    left = place - length[token]
                    if left < 0:
                        break
                    if (prior := last[left]) >= 0:
                        fits = memo.get(prior << 32 | token)
                        if self.compatible(prior, token) if fits is None else fits:
                            break
                    token = shorter[token]
                last.append(token)
            out, place = [], len(text) - 1
            while place >= 0:
                if last[place] < 0:
                    raise ValueError(f"no encoding of {piece!r}: a character is missing from the vocabulary")
                out.append(last[place])
                place -= length[last[place]]
            found[piece] = out[::-1]
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text.  Strings of added tokens in it become those tokens, as in the library."""
        out: list[int] = []
        for part in self.outside.split(text) if self.outside else (text,):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                pieces = [piece for piece, _ in self.split(self.normalize(part))]
                ids = self._pieces(list(set(pieces)))
                for piece in pieces:
                    out += ids[piece]
        return out

    def encode_many(self, words: list[str]) -> list[list[int]]:
        """Ids of each of many words, which are normalized and split together where white space keeps
        them apart; words with other white space or added tokens go one by one."""
        if not self.by_word:
            return [self.encode(w) for w in words]
        kind = [2 if "<" in w and self.outside and self.outside.search(w) else 0 if self.ascii_split and w.isascii() and w.isprintable()
                else 1 if w.split() == [w] else 2 for w in words]
        plain, other = ([w for w, k in zip(words, kind, strict=True) if k == x] for x in (0, 1))
        found = [iter(self._plain(plain)), iter(self._joined(other))]
        return [self.encode(w) if k == 2 else next(found[k]) for w, k in zip(words, kind, strict=True)]

    def _plain(self, words: list[str]) -> list[list[int]]:
        """Plain ASCII words need no Unicode rules: the file's own pattern splits them."""
        if not words:
            return []
        pieces = self.ascii_split.findall("\n".join(words).lower())
        ids = self._pieces(list(set(pieces) - {"\n"}))
        out: list[list[int]] = [[]]
        for piece in pieces:
            if piece == "\n":
                out.append([])
            else:
                out[-1] += ids[piece]
        return out

    def _joined(self, words: list[str]) -> list[list[int]]:
        """Words without white space, joined by blanks; the pieces' places tell whose they are."""
        text = self.normalize(" ".join(words))
        ends = np.cumsum([len(w) + 1 for w in text.split(" ")]).tolist() if words else []
        if len(ends) != len(words):
            return [self.encode(w) for w in words]
        pieces = self.split(text) if words else []
        ids = self._pieces(list({piece for piece, _ in pieces}))
        out: list[list[int]] = [[] for _ in words]
        at = 0
        for piece, (start, _) in pieces:
            while start >= ends[at]:
                at += 1
            out[at] += ids[piece]
        return out

    def texts(self, ids: pa.Array, ends: np.ndarray) -> pa.Array:
        """Decoded texts of id lists, given flat with where each begins: token names joined by a
        blank without a decoder; a byte-level decoder's names are read as bytes."""
        names = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.tokens.take(ids))
        if self.decoder is None:
            return pc.binary_join(names, " ")
        if self.decoder != "ByteLevel":
            raise ValueError(f"decoder {self.decoder} isn't known")
        return pa.array([_bytes_of(x).decode("utf-8", "replace") for x in pc.binary_join(names, "").to_pylist()], pa.string())


def _ascii_split(spec: dict) -> regex.Pattern | None:
    """The file's splitting pattern, with line ends as pieces of their own, if ASCII text is only lower-cased
    and split by it."""
    normal, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    kinds = [x["type"] for x in normal.get("normalizers", ())], [x["type"] for x in split.get("pretokenizers", ())]
    if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
        return None
    cut, level = split["pretokenizers"]
    if cut["behavior"] != "Removed" or not cut["invert"] or level["add_prefix_space"] or level["use_regex"] or normal["normalizers"][1]["pattern"] != {"Regex": r"\s+"}:
        return None
    return regex.compile(r"\n|" + cut["pattern"]["Regex"])


def _byte_characters() -> dict[str, int]:
    """Byte-level characters: printable Latin-1 characters are their bytes, the other bytes follow
    from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


_BYTE = _byte_characters()


def _bytes_of(names: str) -> bytes:
    return b"".join(bytes([_BYTE[c]]) if c in _BYTE else c.encode() for c in names)


_models: dict[str, PrefixBpe] = {}


def model(path: str) -> PrefixBpe:
    """This worker's model of a tokenizer file."""
    if path not in _models:
        _models[path] = PrefixBpe(path)
    return _models[path]


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", decode: bool = False) -> DataFrame:
    """Per row: key, ids (array<int>) and, if ``decode``, decoded (the ids' text again).

    One pass without a shuffle; memory is that of a slice of texts (4 MB, or one longer text) and of the
    word table.  Defined results: null and empty texts have no ids and decode to an empty text; a
    text may be one long word; repeated rows are encoded each; an empty table gives an empty
    table; only the named columns are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(tokenizer)
        for batch in batches:
            for row, stop, ids, ends in word_ids.ids_of(batch.column(1), bpe.words, bpe.by_word):
                flat = pa.array(ids.astype(np.int32))
                columns = [batch.column(0)[row:stop], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
                yield pa.RecordBatch.from_arrays([*columns, bpe.texts(flat, ends)] if decode else columns,
                                                 names=["key", "ids", "decoded"][:2 + decode])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = arrow_map(rows, run, f"key {kind}, ids array<int>" + (", decoded string" if decode else ""))
    return out.withColumnRenamed("key", key)


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: key, decoded.  Null lists decode to null, empty ones to an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(tokenizer)
        for batch in batches:
            lists = batch.column(1)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = bpe.texts(lists.flatten(), np.concatenate([[0], np.cumsum(size)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.if_else(lists.is_valid(), texts, None)], names=["key", "decoded"])

    rows = encoded.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    return arrow_map(rows, run, f"key {kind}, decoded string").withColumnRenamed("key", key)


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256 (decimal ids joined by a blank), decoded_sha256."""
    return encoded.select(
        key, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
