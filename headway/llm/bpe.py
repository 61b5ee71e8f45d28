"""Byte-level BPE encoding and decoding by a trie of distinct words.

A text is cut into words by the pattern of byte-level pre-tokenizers; its ids
are those of its words, one after the other.  The distinct words of a task go
into one trie over their bytes.  For every node, so for every prefix of a word,
one number tells the whole encoding: the last token of the prefix's encoding.
The encoding before that token is the encoding of the shorter prefix, which an
ancestor holds.  Going depth first, each node's last token is found once from
its ancestors', and words with a common prefix share the work for it.

The last token of a node is the one vocabulary entry that (1) is a suffix of the
prefix, (2) is what merging its own bytes gives, and (3) stays apart from the
last token before it.  (3) is decided by replaying the merges at the border of
two tokens: the pieces that touch it grow as each side merges, and the border
stands if no merge across it has its turn before.  This needs merges whose
parts are single bytes or results of earlier merges; a file where that does not
hold, or with settings that change the merging (dropout, normalizers, prefix
spaces, affixes), is refused when it is loaded.

Nulls: a null text is empty, an empty text has no ids; null ids decode to an
empty text.  Repeated rows give repeated rows.  Only the key and the text column
are read, so other columns can't clash.  Strings of added tokens in a text become
their ids, as in the tokenizers library.  Memory per task is one batch of rows, a trie
of about ``TRIE_NODES`` nodes and ``KNOWN_WORDS`` words: what is full is begun anew,
which repeats work but loses none.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import worker_cache

#: Fixed value: the word pattern of byte-level pre-tokenizers.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TRIE_NODES = 300_000
KNOWN_WORDS = 600_000
#: Characters of texts whose words are held at once (a longer text alone).
BLOCK_CHARS = 1 << 20
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files: bytes
    that print stand for themselves, the rest follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _refuse(spec: dict) -> None:
    model, pre, dec = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
    plain = (model.get("type") == "BPE" and not any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk",
        "byte_fallback", "ignore_merges")))
    level = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
             and dec.get("type") == "ByteLevel")
    tokens = not any(a.get(k) for a in spec.get("added_tokens", [])
                     for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if not (plain and level and tokens) or spec.get("normalizer"):
        raise ValueError("not a plain byte-level BPE file")


def load(path: str) -> tuple[dict, dict[int, bytes], dict[str, int]]:
    """(model, bytes of each id, ids of added tokens) of a ``tokenizer.json``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    _refuse(spec)
    letters = byte_letters()
    raw = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    return spec["model"], raw, {a["content"]: a["id"] for a in spec.get("added_tokens", [])}


class Vocabulary:
    """Tokens, merges and the border test of a ``tokenizer.json`` file."""

    def __init__(self, path: str):
        self.path = path
        model, self.bytes_of, self.added = load(path)
        id_of = {b: i for i, b in self.bytes_of.items()}
        self.byte_id = {b[0]: i for i, b in self.bytes_of.items() if len(b) == 1}
        self.rank: dict[tuple[int, int], int] = {}
        #: (left, right, rank) of a token that its own bytes merge to.
        self.split: dict[int, tuple[int, int, int]] = {}
        made = set(self.byte_id.values())
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, to = (model["vocab"][x] for x in (a, b, a + b))
            if left not in made or right not in made:
                raise ValueError("a merge uses a token that no earlier merge makes")
            made.add(to)
            self.rank[left, right] = rank
        self.length = {i: len(b) for i, b in self.bytes_of.items()}
        self.met: dict[int, int] = {}
        self.spines: tuple[dict, dict] = {}, {}
        for (left, right), rank in self.rank.items():
            whole = id_of[self.bytes_of[left] + self.bytes_of[right]]
            if whole not in self.split and self.own(left) and self.own(right) and self._meet(left, right) == rank:
                self.split[whole] = (left, right, rank)
        self._suffixes()
        self.cut = regex.compile("(" + "|".join(
            regex.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.word = regex.compile(WORD)
        self.usual: set[str] = set()

    def _suffixes(self) -> None:
        """An automaton over bytes whose state knows every own token that ends
        there, the longest first."""
        self.step: dict[int, int] = {}
        self.ending: list[tuple[int, ...]] = [()]
        depth = [[0]]
        for token, raw in self.bytes_of.items():
            if self.own(token):
                state = 0
                for d, byte in enumerate(raw):
                    edge = state * 256 + byte
                    if edge not in self.step:
                        self.step[edge] = len(self.ending)
                        self.ending.append(())
                        if d + 1 == len(depth):
                            depth.append([])
                        depth[d + 1].append(edge)
                    state = self.step[edge]
                self.ending[state] = (token,)
        self.shorter = [0] * len(self.ending)
        tree = set(self.step)
        for edges in depth[1:]:
            for edge in edges:
                state, up, byte = self.step[edge], edge // 256, edge % 256
                if up:
                    up = self.shorter[up]
                    while up and up * 256 + byte not in tree:
                        up = self.shorter[up]
                    self.shorter[state] = self.step.get(up * 256 + byte, 0)
                self.ending[state] += self.ending[self.shorter[state]]

    def after(self, state: int, byte: int) -> int:
        """The automaton's next state, remembered as an edge of its own."""
        edge, up = state * 256 + byte, state
        while up and up * 256 + byte not in self.step:
            up = self.shorter[up]
        self.step[edge] = self.step.get(up * 256 + byte, 0)
        return self.step[edge]

    def own(self, token: int) -> bool:
        """Whether the token's bytes, merged alone, give it."""
        return token in self.split or len(self.bytes_of[token]) == 1

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces of a token that touch its right (1) or left (0) end, as
        (piece, rank of the merge that makes it), the shortest first."""
        found = self.spines[side].get(token)
        if found is None:
            left, right, rank = self.split.get(token, (token, token, -1))
            found = [] if rank < 0 else self._spine((left, right)[side], side)
            found = self.spines[side][token] = [*found, (token, rank)]
        return found

    def _meet(self, left: int, right: int) -> int:
        """Rank of the merge that crosses the border of two tokens; NEVER if
        both are made and none does."""
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            across = self.rank.get((a[i][0], b[j][0]), NEVER)
            grow_left = a[i + 1][1] if i + 1 < len(a) else NEVER
            grow_right = b[j + 1][1] if j + 1 < len(b) else NEVER
            # Of equal ranks, the merge further left has its turn first.
            if across < NEVER and across < grow_left and across <= grow_right:
                return across if i + 1 == len(a) and j + 1 == len(b) else -1
            if grow_left == grow_right == NEVER:
                return NEVER
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def meet(self, left: int, right: int) -> int:
        """As :meth:`_meet`, remembered; NEVER if two neighbours stay two."""
        found = self.met[left << 32 | right] = self._meet(left, right)
        return found

    def words(self, text: str) -> list[str]:
        """The words of a text without added tokens.  Characters that Unicode
        got after Python's own table are judged by the library's."""
        new = set(text) - self.usual
        odd = {c for c in new if unicodedata.category(c) == "Cn"}
        self.usual |= new - odd
        if not odd:
            return self.word.findall(text)
        if not hasattr(self, "_library"):
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]


class WordTrie:
    """Words inserted byte by byte; per node its last token, the node that holds
    the encoding before it, and the automaton's state."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.child: dict[int, int] = {}
        self.last, self.before, self.state = array("i", [-1]), array("i", [0]), array("i", [0])

    def _grow(self, path: list[int], byte: int) -> int:
        """A new node below the path's end: its last token is the one that fits
        behind the last token of the ancestor where it begins."""
        v, last = self.vocabulary, self.last
        up = self.state[path[-1]]
        state = v.step.get(up * 256 + byte)
        if state is None:
            state = v.after(up, byte)
        for token in v.ending[state]:
            at = path[-v.length[token]]
            if not at or (v.met.get(last[at] << 32 | token) or v.meet(last[at], token)) == NEVER:
                node = self.child[path[-1] * 256 + byte] = len(last)
                last.append(token)
                self.before.append(at)
                self.state.append(state)
                return node
        raise AssertionError("no token ends this prefix")

    def add(self, words: Iterable[str]) -> dict[str, bytes]:
        """Walk the trie depth first along sorted words, growing new nodes; each
        word's ids as 32-bit numbers."""
        child, last, before, found = self.child, self.last, self.before, {}
        path, earlier = [0], b""
        for w in sorted(words):
            raw, same = w.encode("utf-8"), 0
            for a, b in zip(earlier, raw):  # noqa: B905
                if a != b:
                    break
                same += 1
            del path[same + 1:]
            for byte in raw[same:]:
                node = child.get(path[-1] * 256 + byte)
                path.append(self._grow(path, byte) if node is None else node)
            earlier, node, out = raw, path[-1], []
            while node:
                out.append(last[node])
                node = before[node]
            found[w] = array("i", out[::-1]).tobytes()
        return found


class Encoder:
    """Encodes texts, into 32-bit ids.  Words are remembered, and one trie goes on
    over the texts that it is given; each begins anew when it is full."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.trie = WordTrie(self.vocabulary)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        out, block, size = [], [], 0
        for t in texts:
            if block and size + len(t) > BLOCK_CHARS:
                out += self._block(block)
                block, size = [], 0
            block.append(t)
            size += len(t)
        return out + self._block(block)

    def _block(self, texts: list[str]) -> list[bytes]:
        v = self.vocabulary
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        if len(self.trie.last) > TRIE_NODES:
            self.trie = WordTrie(v)
            v.met.clear()
        # Parts between added tokens, the tokens themselves at odd places.
        parts = [v.cut.split(t) if v.cut and v.cut.search(t) else [t] for t in texts]
        words = [[[p] if i % 2 else v.words(p) for i, p in enumerate(own)] for own in parts]
        known = self.known
        known.update(self.trie.add(set(chain.from_iterable(w for own in words for w in own[::2])) - known.keys()))
        return [b"".join([np.int32(v.added[part[0]]).tobytes() if i % 2 else b"".join(map(known.__getitem__, part))
                          for i, part in enumerate(own)]) for own in words]


class Decoder:
    """Ids to texts; an id that no token has adds nothing."""

    def __init__(self, path: str):
        _, raw, added = load(path)
        by_id = raw | {i: t.encode("utf-8") for t, i in added.items()}
        top = max(by_id) + 1
        self.length = np.array([len(by_id.get(i, b"")) for i in range(top)] + [0])
        self.start = np.concatenate(([0], np.cumsum(self.length)))[:-1]
        self.raw = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(top)), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        ids = np.where((ids < 0) | (ids >= len(self.length) - 1), len(self.length) - 1, ids)
        n = self.length[ids]
        where = np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.raw[where].tobytes().decode("utf-8", "replace")


def _kept(kind: type, path: str):
    """The worker process's encoder or decoder for a file."""
    cache = worker_cache()
    name = f"bpe:{kind.__name__}:{path}"
    if name not in cache:
        cache[name] = kind(path)
    return cache[name]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of every row: the token ids of its whole text."""
    src = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(Encoder, path)
        for batch in batches:
            ids = encoder.encode(batch.column(1).to_pylist())
            flat = np.frombuffer(b"".join(ids), np.int32)
            offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["key", "ids"])

    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, text) of every row: what its ids stand for, added tokens too."""
    src = rows.select(F.col(key).alias("key"), F.coalesce(F.col(ids), F.array()).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _kept(Decoder, path)
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))))
            texts = [decoder.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), column, pa.array(texts, pa.string())], ["key", "ids", "text"])

    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, ids array<int>, text string").withColumnRenamed("key", key)
