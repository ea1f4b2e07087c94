"""Byte-level BPE encoding and decoding by speculation: propose, verify, and merge only where the proposal fails.

A text is cut at special tokens and then into words by the tokenizer's pattern. Each distinct word of a batch that is not in
the task's memory gets a proposal, the greedy longest match from the left. The proposal is what merging would give if and
only if every adjacent pair of tokens is *compatible*: if merging the bytes of both leaves the boundary between them alone.
All pairs of all proposals of a batch are tested at once with arrays. Words with a failing pair are merged exactly.

**The test of a pair.** Walk back in time from the finished tokens (left, right): undo whichever of the two was made by the
later merge, keeping the piece that touches the boundary. This visits exactly the pairs of pieces that were neighbours at
the boundary at some time. If one of them has a merge of its own that would have come before the merges that took the pieces
in, the boundary would not have survived. Of equal merges the left one comes first.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.common import map_batches, sql_type, texts

#: The pattern of byte-level pre-tokenization and its white space.
_SPACES = r"\t\n\v\f\r\x20\x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACES}\p{{L}}\p{{N}}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
#: The same pattern for texts of ASCII, accented Latin letters and common punctuation only, which the standard module's faster
#: expressions can spell out; an alternative that shares no first character with those before it may come first.
_LATIN = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_IS_LATIN = re.compile(rf"[\x00-\x7f{_LATIN[6:]}\u2010-\u2027\u2030-\u205e\u20ac]*").fullmatch
_FIND_LATIN = re.compile(
    rf" ?[{_LATIN}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\t\n\v\f\r\x20{_LATIN}0-9]+"
    r"|[\t\n\v\f\r\x20]+(?![^\t\n\v\f\r\x20])|[\t\n\v\f\r\x20]+"
).findall
_FIND = regex.compile(PATTERN).findall
#: Words up to this many bytes are merged together as rows of a table.
_SHORT = 40
#: Words in each half of a worker's memory beside those of the piece, and the longest word it remembers; others are encoded again.
_MEMORY, _LONGEST = 100_000, 64
#: Texts of about this many characters are cut into words at once, and so many words are encoded at once.
_PIECE, _WORDS = 1 << 18, 10_000


def _byte_of_letter() -> dict[str, int]:
    """The alphabet of byte-level vocabularies: printable bytes stand for themselves, others for letters from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def words_in(text: str) -> list[str]:
    return (_FIND_LATIN if _IS_LATIN(text) else _FIND)(text)


class Vocabulary:
    """Arrays of a byte-level BPE vocabulary: bytes of tokens, merges by rank, and the pieces each token is made of."""

    def __init__(self, pieces: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int]):
        self.ids = pieces
        self.special = special
        count = 1 + max([-1, *pieces.values(), *special.values()])
        self.bytes = [b""] * count
        for piece, token in pieces.items():
            self.bytes[token] = piece
        for text, token in special.items():
            self.bytes[token] = text.encode()
        self.ranks = {(pieces[a], pieces[b]): (rank, pieces[a + b]) for rank, (a, b) in reversed([*enumerate(merges)])}
        # How each token is made: the rank of its merge (-1: a byte) and the pieces on either side.
        self.made = np.full(count, -1, dtype=np.int64)
        self.left, self.right = np.arange(count), np.arange(count)
        for (a, b), (rank, token) in sorted(self.ranks.items(), key=lambda item: -item[1][0]):
            self.made[token], self.left[token], self.right[token] = rank, a, b
        self._joined = np.array([pieces[a + b] for a, b in merges], dtype=np.int64)
        self._span = np.int64(count)
        pairs = np.array([a * count + b for a, b in self.ranks], dtype=np.int64)
        order = np.argsort(pairs)
        self._pairs = pairs[order]
        self._pair_ranks = np.array([rank for rank, _ in self.ranks.values()], dtype=np.int64)[order]
        # A token that merging its own bytes does not give is never proposed.
        merged = np.flatnonzero(self.made >= 0)
        sound = self.compatible(self.left[merged], self.right[merged], self.made[merged])
        unsound = set(merged[~sound].tolist())
        while unsound:
            more = {t for t in merged.tolist() if t not in unsound and {int(self.left[t]), int(self.right[t])} & unsound}
            if not more:
                break
            unsound |= more
        self.proposed = {piece: token for piece, token in pieces.items() if token not in unsound}
        # A tree of the proposed pieces: steps as sorted numbers (node * 256 + byte), and the token that ends at each node.
        nodes: dict[bytes, int] = {b"": 0}
        for piece in self.proposed:
            for end in range(1, len(piece) + 1):
                nodes.setdefault(piece[:end], len(nodes))
        steps = np.array([nodes[path[:-1]] * 256 + path[-1] for path in nodes if path], dtype=np.int64)
        order = np.argsort(steps)
        self._steps, self._step_to = steps[order], np.arange(1, len(nodes))[order]
        self._ends = np.array([self.proposed.get(path, -1) for path in nodes], dtype=np.int64)
        self._byte_ids = np.array([pieces[bytes([b])] for b in range(256)] if len(pieces) > 255 else [], dtype=np.int64)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a tokenizer file; refuses settings that this encoder does not follow."""
        with open(path, encoding="utf-8") as file:
            spec: dict[str, Any] = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if model["type"] != "BPE" or spec["normalizer"] or not plain or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        letters = _byte_of_letter()
        special = {token["content"]: token["id"] for token in spec["added_tokens"]}

        def raw(piece: str) -> bytes:
            return bytes(letters[letter] for letter in piece)

        merges = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        return cls({raw(p): t for p, t in model["vocab"].items() if p not in special}, merges, special)

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; a very large number where there is none."""
        none = np.iinfo(np.int64).max
        if not len(self._pairs):
            return np.full(len(a), none)
        wanted = a * self._span + b
        at = np.minimum(np.searchsorted(self._pairs, wanted), len(self._pairs) - 1)
        return np.where(self._pairs[at] == wanted, self._pair_ranks[at], none)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether the boundary between each pair of tokens survives all merges (or those before ``until``)."""
        end = np.iinfo(np.int64).max
        good = np.ones(len(a), dtype=bool)
        row, a, b = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        # The merges that take the two pieces in.
        a_ends = np.full(len(a), end) if until is None else until.astype(np.int64)
        b_ends = a_ends - (0 if until is None else 1)
        while len(row):
            rank = self._merge_rank(a, b)
            fails = (rank != end) & (rank < a_ends) & (rank <= b_ends)
            good[row[fails]] = False
            undo_a = self.made[a] > self.made[b]
            open_ = ~fails & ((self.made[a] >= 0) | (self.made[b] >= 0))
            row, a, b, a_ends, b_ends, undo_a = (x[open_] for x in (row, a, b, a_ends, b_ends, undo_a))
            a_ends, b_ends = np.where(undo_a, self.made[a], a_ends), np.where(undo_a, b_ends, self.made[b])
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return good

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match from the left in all words at once: (tokens, row of each), by row and place."""
        text = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        ends = np.cumsum([len(word) for word in words])
        rows, at = np.arange(len(words)), np.concatenate(([0], ends[:-1]))
        rows, at = rows[at < ends], at[at < ends]
        tokens_found, rows_found = [], []
        while len(rows):
            token, stop = np.full(len(rows), -1, dtype=np.int64), at.copy()
            going, node, here, last = np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64), at, ends[rows]
            while len(going):
                wanted = node * 256 + text[here]
                step = np.minimum(np.searchsorted(self._steps, wanted), len(self._steps) - 1)
                there = self._steps[step] == wanted
                going, node, here, last = going[there], self._step_to[step[there]], here[there] + 1, last[there]
                whole = self._ends[node] >= 0
                token[going[whole]], stop[going[whole]] = self._ends[node[whole]], here[whole]
                inside = here < last
                going, node, here, last = going[inside], node[inside], here[inside], last[inside]
            tokens_found.append(token), rows_found.append(rows)
            inside = stop < ends[rows]
            rows, at = rows[inside], stop[inside]
        if not rows_found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        of = np.concatenate(rows_found)
        order = np.argsort(of, kind="stable")
        return np.concatenate(tokens_found)[order], of[order]

    def merge(self, word: bytes) -> list[int]:
        """Exact merging of a long word, lowest rank first and the left one of equals, with a heap over a linked list."""
        tokens: list[int | None] = [self.ids[word[i : i + 1]] for i in range(len(word))]
        after, before = [*range(1, len(word) + 1)], [*range(-1, len(word) - 1)]
        ranks, none = self.ranks, (None, None)
        heap = [
            (ranks[pair][0], i, *pair) for i, pair in enumerate(zip(tokens, tokens[1:], strict=False)) if pair in ranks
        ]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != a or j >= len(tokens) or tokens[j] != b:
                continue
            tokens[i], tokens[j] = ranks[a, b][1], None
            after[i] = after[j]
            if after[i] < len(tokens):
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < len(tokens):
                    pair = (tokens[left], tokens[after[left]])
                    rank, _ = ranks.get(pair, none)
                    if rank is not None:
                        heapq.heappush(heap, (rank, left, *pair))
        return [token for token in tokens if token is not None]

    def merge_short(self, words: list[bytes]) -> list[list[int]]:
        """Exact merging of short words, all at once: one row for each word, one merge in each row at a time."""
        none = np.iinfo(np.int64).max
        lengths = np.array([len(word) for word in words])
        width = int(lengths.max()) + 1
        filled = np.arange(width)[None, :] < lengths[:, None]
        tokens = np.full(filled.shape, -1, dtype=np.int64)
        tokens[filled] = self._byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        ranks = np.full(filled.shape, none)
        pairs = filled[:, 1:].nonzero()
        ranks[pairs] = self._merge_rank(tokens[pairs], tokens[pairs[0], pairs[1] + 1])
        out: list[list[int]] = [[]] * len(words)
        rows = np.arange(len(words))
        while len(rows):
            at = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            ends = ranks[each, at] == none
            for row, found in zip(rows[ends].tolist(), tokens[ends].tolist(), strict=True):
                out[row] = found[: found.index(-1)]
            rows, tokens, ranks, at = rows[~ends], tokens[~ends], ranks[~ends], at[~ends]
            if not len(rows):
                break
            each = np.arange(len(rows))
            joined = self._joined[ranks[each, at]]
            # Close the gap: what stands right of the merged pair moves one place left.
            source = np.arange(width)[None, :] + (np.arange(width)[None, :] > at[:, None])
            source = np.minimum(source, width - 1)
            tokens, ranks = np.take_along_axis(tokens, source, 1), np.take_along_axis(ranks, source, 1)
            tokens[each, at] = joined
            after, before = tokens[each, np.minimum(at + 1, width - 1)], tokens[each, np.maximum(at - 1, 0)]
            ranks[each, at] = np.where(after >= 0, self._merge_rank(joined, np.maximum(after, 0)), none)
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self._merge_rank(before[inner], joined[inner])
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Packed tokens of distinct words: proposals, one test of all adjacent pairs, exact merging where it fails."""
        flat, of = self.propose(words)
        inner = np.flatnonzero(of[1:] == of[:-1])
        fails = ~self.compatible(flat[inner], flat[inner + 1])
        failed = np.unique(of[inner[fails]]).tolist()
        packed = flat.astype("<u4").tobytes()
        stops = np.cumsum(np.bincount(of, minlength=len(words))) * 4
        out = [packed[a:b] for a, b in zip([0, *stops.tolist()], stops.tolist(), strict=False)]
        short = [n for n in failed if len(words[n]) <= _SHORT]
        for start in range(0, len(short), 10_000):
            some = short[start : start + 10_000]
            for n, tokens in zip(some, self.merge_short([words[n] for n in some]), strict=True):
                out[n] = struct.pack(f"<{len(tokens)}I", *tokens)
        for n in failed:
            if len(words[n]) > _SHORT:
                out[n] = np.array(self.merge(words[n]), dtype="<u4").tobytes()
        return out


class Codec:
    """Encoder and decoder of one task; remembers the tokens of words as packed 32-bit numbers.

    The memory has two halves. A word of the older one that is met again goes over to the newer; when that is full it becomes
    the older, whose words that were not met since are forgotten.
    """

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary = vocabulary
        longest_first = sorted(vocabulary.special, key=len, reverse=True)
        self._specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        """Add the tokens of all words of a piece."""
        if len(self._known) > _MEMORY:
            self._known, self._older = {}, self._known
        new = []
        for word in words.difference(self._known):
            packed = self._older.pop(word, None)
            if packed is None:
                new.append(word)
            else:
                self._known[word] = packed
        for start in range(0, len(new), _WORDS):
            some = new[start : start + _WORDS]
            encoded = self._vocabulary.encode_words([word.encode() for word in some])
            self._known.update(zip(some, encoded, strict=True))

    def encode(self, documents: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; what is held beside them are the words of a piece."""
        out: list[bytes] = []
        piece: list[str] = []
        size = 0
        for text in documents:
            piece.append(text)
            size += len(text)
            if size >= _PIECE:
                out += self._encode(piece)
                piece, size = [], 0
        return out + self._encode(piece) if piece else out

    def _encode(self, documents: list[str]) -> list[bytes]:
        split = self._specials.split if self._specials else lambda text: [text]
        cut = [[words_in(part) if n % 2 == 0 else part for n, part in enumerate(split(text))] for text in documents]
        words = set().union(*(part for parts in cut for part in parts[::2]))
        self._learn(words)
        known = self._known
        out: list[bytes] = []
        for parts in cut:
            packed = [
                np.array([self._vocabulary.special[part]], dtype="<u4").tobytes() if n % 2
                else b"".join(map(known.__getitem__, part))
                for n, part in enumerate(parts)
            ]
            out.append(packed[0] if len(packed) == 1 else b"".join(packed))
        for word in words:
            if len(word) > _LONGEST:
                del known[word]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are not UTF-8 become replacement characters."""
        pieces = self._vocabulary.bytes
        return b"".join([pieces[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


_CODECS: dict[int, Codec] = {}


def _codec(shared: Broadcast) -> Codec:
    """One codec for each Python worker and vocabulary, so that words learned by one task serve the next."""
    vocabulary = shared.value
    if id(vocabulary) not in _CODECS:
        _CODECS.clear()
        _CODECS[id(vocabulary)] = Codec(vocabulary)
    return _CODECS[id(vocabulary)]


def share(spark: SparkSession, path: str) -> Broadcast:
    """Send a vocabulary to the executors; its size is that of the tokenizer's file, whatever the data."""
    return spark.sparkContext.broadcast(Vocabulary.load(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row; NULL and empty texts have no ids, repeated rows are repeated."""
    shared = share(docs.sparkSession, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared)
        packed = codec.encode([text.decode("utf-8", "replace") for text in texts(batch.column(1))])
        offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed]))).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))
        ids = pa.ListArray.from_arrays(pa.array(offsets), values)
        return pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "ids"])

    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {sql_type(docs, id_col)}, ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of token ids; NULL counts as no ids."""
    shared = share(tokens.sparkSession, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared)
        rows = [np.array(ids or [], dtype="<u4").tobytes() for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([codec.decode(r) for r in rows])], [id_col, "text"])

    return map_batches(tokens.select(id_col, ids_col), run, f"`{id_col}` {sql_type(tokens, id_col)}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: encode, decode the ids, and digest both.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit numbers, ``decoded_sha256`` over the decoded text in
    UTF-8. NULL and empty texts have no ids and decode to the empty text. Special tokens in a text become their own ids.
    Texts may be of any length; repeated rows are repeated, an empty table gives an empty result, and other columns of
    ``docs`` are not looked at.
    """
    shared = share(docs.sparkSession, path)
    schema = f"`{id_col}` {sql_type(docs, id_col)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared)
        packed = codec.encode([text.decode("utf-8", "replace") for text in texts(batch.column(1))])
        columns = [
            batch.column(0),
            pa.array([len(p) // 4 for p in packed], pa.int64()),
            pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
            pa.array([hashlib.sha256(codec.decode(p).encode()).hexdigest() for p in packed]),
        ]
        return pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.select(id_col, text_col), run, schema)
