"""Byte-level BPE encoding and decoding of whole texts with a given vocabulary file.

Texts are split into words by the pattern of byte-level BPE, and each distinct word is encoded once.

* *Speculate.* The longest vocabulary entry that the rest of the word begins with is taken, again and again.
* *Verify.* A row of tokens is what merging yields exactly if no merge ever happens across the border of two
  neighbours, so all adjacent pairs of all proposals are tested together, with arrays (:meth:`Vocabulary.compatible`).
* *Merge.* Only words with an incompatible pair are merged from their bytes, least merge first.

The file is read once, by the driver, and its tables, whose size the file fixes, go to the tasks.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from nearspan.llm.bytesets import pieces
from nearspan.llm.common import whole

LONG_WORD = 64
NEVER = np.int64(1) << 40
BLANK = 4
# What a contraction ends in.
SHORT_ENDINGS = [ord(c) for c in "stmd"]
LONG_ENDINGS = np.array([ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")])


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if it prints, else the next free one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return {chr(b if b in prints else next(free)): b for b in range(256)}


class Vocabulary:
    """Tokens, merges and the word splitter of a byte-level BPE file of the tokenizers library."""

    def __init__(self, text: str):
        file = json.loads(text)
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        model = file["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = model["vocab"]
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for name, token in vocab.items():
            self.bytes[token] = bytes(letters[c] for c in name)
        for name, token in self.special.items():
            self.bytes[token] = name.encode()
        single = {self.bytes[t][0]: t for t in vocab.values() if len(self.bytes[t]) == 1}
        self.byte_tokens = np.array([single[b] for b in range(256)])
        # The merge that makes a token, and its parts; single bytes are there from the start.
        self.made, self.left, self.right = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
        pairs = np.zeros((len(merges), 2), np.int64)
        self.makes = np.zeros(len(merges), np.int64)
        for rank, (a, b) in enumerate(merges):
            pairs[rank], self.makes[rank] = (vocab[a], vocab[b]), vocab[a + b]
            if self.made[vocab[a + b]] < 0:
                self.made[vocab[a + b]], self.left[vocab[a + b]], self.right[vocab[a + b]] = rank, vocab[a], vocab[b]
        if (self.made[pairs].max(1, initial=-1) >= np.arange(len(merges))).any():
            raise ValueError("a merge comes before the one that makes its part")
        self.merge = {(a, b): rank for rank, (a, b) in enumerate(pairs.tolist())}
        keys = pairs[:, 0] * size + pairs[:, 1]
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.size = size
        # A token is proposed only if merging its own bytes gives it, and so for its parts.
        whole_parts = self.compatible(self.left, self.right, np.where(self.made < 0, NEVER, self.made))
        sound = np.array([len(b) == 1 for b in self.bytes])
        for token in np.argsort(self.made, kind="stable"):
            if self.made[token] >= 0:
                sound[token] = whole_parts[token] and sound[self.left[token]] and sound[self.right[token]]
        self._build_trie({self.bytes[t]: t for t in vocab.values() if sound[t]})

    def _build_trie(self, tokens: dict[bytes, int]) -> None:
        nodes, arcs = {b"": 0}, {}
        for name in tokens:
            for i in range(1, len(name) + 1):
                if name[:i] not in nodes:
                    nodes[name[:i]] = len(nodes)
                    arcs[nodes[name[: i - 1]] * 256 + name[i - 1]] = nodes[name[:i]]
        self.arcs = np.array(sorted(arcs), np.int64)
        self.behind = np.array([arcs[key] for key in self.arcs.tolist()], np.int64)
        self.accepts = np.full(len(nodes), -1)
        for name, token in tokens.items():
            self.accepts[nodes[name]] = token

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of the merge of each pair; ``NEVER`` if there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], NEVER)

    def compatible(self, left: np.ndarray, right: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge happens across the border of each pair of tokens (before merge ``until``, if given).

        While the bytes of the two are merged, the piece left of the border is one of the pieces at the right edge
        of ``left``, from a byte to all of it, and the piece right of it one at the left edge of ``right``.  From
        the end of merging backwards, the one of the two that was made later gives way to its part at the border.
        Pieces that exist at the same time would be merged if their own merge came before either is used up; among
        equal merges the leftmost goes first, so it must come before the left piece's and not after the right's.
        """
        until = np.full(len(left), NEVER) if until is None else until
        fine = np.ones(len(left), bool)
        row = np.arange(len(left))
        x, y, x_used, y_used = left.copy(), right.copy(), until.copy(), until.copy()
        if len(row):
            # The pair's own merge is not a fault when it is the one that ``until`` names.
            x_used, y_used = until.copy(), until - (until < NEVER)
        while len(row):
            rank = self.rank(x, y)
            clash = (rank < x_used) & (rank <= y_used) & (rank < NEVER)
            fine[row[clash]] = False
            later = self.made[x] >= self.made[y]
            made = np.where(later, self.made[x], self.made[y])
            x, x_used = np.where(later, self.right[x], x), np.where(later, made, x_used)
            y, y_used = np.where(later, y, self.left[y]), np.where(later, y_used, made)
            on = (made >= 0) & ~clash
            row, x, y, x_used, y_used = row[on], x[on], y[on], x_used[on], y_used[on]
        return fine

    def propose(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at each place of the words, from left to right: tokens in order, and the word of each.

        All words walk the trie of the vocabulary at the same time, one token a round.
        """
        tokens, owners = [], []
        on, at = np.flatnonzero(begin < end), begin.copy()
        while len(on):
            best, after = np.full(len(on), -1), at[on]
            row, node, place = np.arange(len(on)), np.zeros(len(on), np.int64), at[on]
            while len(row):
                node = self.child(node, data[place])
                inside = node >= 0
                row, node, place = row[inside], node[inside], place[inside] + 1
                hit = self.accepts[node] >= 0
                best[row[hit]], after[row[hit]] = self.accepts[node[hit]], place[hit]
                more = place < end[on[row]]
                row, node, place = row[more], node[more], place[more]
            if (best < 0).any():
                raise ValueError(f"no token begins with byte {data[at[on[np.argmin(best)]]]}")
            tokens.append(best)
            owners.append(on)
            at[on] = after
            on = on[at[on] < end[on]]
        owner = np.concatenate([*owners, np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([*tokens, np.zeros(0, np.int64)])[order], owner[order]

    def child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The trie node behind each node and byte; -1 if there is none."""
        key = node * 256 + byte
        at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
        return np.where(self.arcs[at] == key, self.behind[at], -1)

    def merged(self, token: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of words by merging, from the tokens of their bytes: the least merge of each word first.

        All words are merged at the same time; a round does all places of the least merge of each word, from the left.
        A word that is done, or long, leaves the rounds.
        """
        done_token, done_owner = [], []
        long = np.bincount(owner)[owner] > LONG_WORD if len(owner) else np.zeros(0, bool)
        for word in np.unique(owner[long]):
            tokens = self.merged_long(token[owner == word].tolist())
            done_token.append(np.array(tokens, np.int64))
            done_owner.append(np.full(len(tokens), word))
        token, owner = token[~long], owner[~long]
        while len(token):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rank = np.full(len(token), NEVER)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inner] = self.rank(token[inner], token[inner + 1])
            least = np.minimum.reduceat(rank, first)
            word = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(token)]))
            still = least[word] < NEVER
            done_token.append(token[~still])
            done_owner.append(owner[~still])
            at = np.flatnonzero(still & (rank == least[word]))
            # Of places that overlap, as in a run of one letter, every other one is taken.
            begins = np.flatnonzero(np.r_[True, np.diff(at) != 1])
            streak = np.repeat(begins, np.diff(np.r_[begins, len(at)]))
            at = at[(np.arange(len(at)) - streak) % 2 == 0]
            token = token.copy()
            token[at] = self.makes[rank[at]]
            still[at + 1] = False
            token, owner = token[still], owner[still]
        token, owner = np.concatenate([*done_token, token]), np.concatenate([*done_owner, owner])
        order = np.argsort(owner, kind="stable")
        return token[order], owner[order]

    def merged_long(self, token: list[int]) -> list[int]:
        """The same for one word of any length, with a queue of its merges."""
        after = [*range(1, len(token)), -1]
        before = [*range(-1, len(token) - 1)]
        waiting = [(self.merge[p], i) for i, p in enumerate(zip(token, token[1:])) if p in self.merge]
        heapq.heapify(waiting)
        while waiting:
            rank, at = heapq.heappop(waiting)
            then = after[at]
            if then < 0 or token[at] < 0 or self.merge.get((token[at], token[then])) != rank:
                continue
            token[at], token[then] = int(self.makes[rank]), -1
            after[at] = after[then]
            if after[at] >= 0:
                before[after[at]] = at
            for i in (before[at], at):
                if i >= 0 and after[i] >= 0 and (pair := (token[i], token[after[i]])) in self.merge:
                    heapq.heappush(waiting, (self.merge[pair], i))
        return [t for t in token if t >= 0]

    def encode_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the words, and where each word's begin: proposals, all their pairs tested, failing words merged."""
        begin, end = offsets[:-1], offsets[1:]
        token, owner = self.propose(data, begin, end)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pair, place = np.unique(token[inner] * self.size + token[inner + 1], return_inverse=True)
        fine = self.compatible(pair // self.size, pair % self.size)[place]
        failing = np.unique(owner[inner[~fine]])
        size = (end - begin)[failing]
        which = np.repeat(failing, size)
        byte = data[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + begin[which]]
        new_token, new_owner = self.merged(self.byte_tokens[byte], which)
        kept = np.ones(len(begin), bool)
        kept[failing] = False
        kept = kept[owner]
        token, owner = np.concatenate([token[kept], new_token]), np.concatenate([owner[kept], new_owner])
        order = np.argsort(owner, kind="stable")
        return token[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(begin)))])


class Splitter:
    """Splits texts into the words within which merges happen, on whole arrays of characters.

    A word is a row of letters, of digits or of other signs, each with the blank before it if there is one; one of the
    contractions; or white space, of which the last character stands alone, or goes with what follows if it is a blank.
    Which class a character has is asked of the tokenizers library, once per character.
    """

    def __init__(self, special: Iterable[str]):
        self.library = ByteLevel(add_prefix_space=False)
        self.kinds = np.zeros(0x110000, np.uint8)
        names = sorted((name.encode() for name in special), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, names))) if names else None

    def kind(self, char: int) -> int:
        joined = [i for i, c in enumerate("a1!", 1) if len(self.library.pre_tokenize_str(c + chr(char))) == 1]
        return joined[0] if joined else BLANK

    def split(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where words begin in the UTF-8 bytes of the rows."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        if not len(lead):
            return lead
        char = data[lead].astype(np.int32)
        size = 1 + (char >= 0xC0) + (char >= 0xE0) + (char >= 0xF0)
        for n, mask in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
            wide = np.flatnonzero(size == n)
            value = char[wide] & mask
            for i in range(1, n):
                value = value << 6 | (data[lead[wide] + i] & 0x3F)
            char[wide] = value
        kind = self.kinds[char]
        if not kind.all():
            for new in np.unique(char[kind == 0]).tolist():
                self.kinds[new] = self.kind(new)
            kind = self.kinds[char]
        n = len(char)
        # Nothing reaches across the border of a row or of a special token.
        border = np.zeros(n + 1, bool)
        border[np.searchsorted(lead, offsets)] = True
        border[n] = True
        special = self.found(data, offsets)
        for a, b in special:
            border[np.searchsorted(lead, [a, b])] = True
        follows = np.ones(n + 1, bool)
        follows[1:n] = (kind[1:] != kind[:-1]) | border[1:n]
        cut = follows.copy()
        last = np.flatnonzero((kind == BLANK) & follows[1:] & ~border[1:])
        cut[last] = True
        cut[last[char[last] == 32] + 1] = False
        quote = np.flatnonzero((char == 39) & cut[:n] & follows[1:] & ~border[1:])
        one = np.r_[char, 0, 0, 0][quote + 1]
        two = np.where(border[np.minimum(quote + 2, n)], 0, np.r_[char, 0, 0, 0][quote + 2])
        short = np.isin(one, SHORT_ENDINGS)
        long = (one * 256 + np.minimum(two, 255))[:, None] == LONG_ENDINGS
        for at, size in ((quote[short], 2), (quote[long.any(1)], 3)):
            cut[at + 1] = False
            cut[at + size] = True
        for a, b in special:
            i, j = np.searchsorted(lead, [a, b])
            cut[i + 1 : j] = False
        return lead[np.flatnonzero(cut[:n])]

    def found(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Begin and end of the special tokens in the rows."""
        if self.special is None:
            return []
        text = data.tobytes()
        if not self.special.search(text):
            return []
        rows = zip(offsets[:-1].tolist(), offsets[1:].tolist())
        return [m.span() for a, b in rows for m in self.special.finditer(text, a, b)]


def encode_rows(
    vocabulary: Vocabulary, splitter: Splitter, data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the rows and where each row's begin; every distinct word is encoded once."""
    begin = splitter.split(data, offsets)
    bounds = np.r_[begin, len(data)].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    which, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    names = pa.array(list(vocabulary.special), pa.large_string()).cast(pa.large_binary())
    special = pc.index_in(distinct, value_set=names).fill_null(-1).to_numpy()
    ends = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1] if len(distinct) else np.zeros(1, np.int64)
    letters = np.frombuffer(distinct.buffers()[2], np.uint8) if len(distinct) else np.zeros(0, np.uint8)
    token, first = vocabulary.encode_words(letters, ends)
    for i in np.flatnonzero(special >= 0).tolist():
        # The file's own tokens are taken as they are.
        value = list(vocabulary.special.values())[special[i]]
        token = np.r_[token[: first[i]], value, token[first[i + 1] :]]
        first[i + 1 :] += 1 - (first[i + 1] - first[i])
    size = np.diff(first)[which]
    start = np.cumsum(size) - size
    ids = token[np.arange(size.sum()) - np.repeat(start - first[which], size)]
    return ids, np.r_[start, len(ids)][np.searchsorted(begin, offsets)]


def _sent(frame: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return frame.sparkSession.sparkContext.broadcast(Vocabulary(file.read()))


def _with(frame: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*frame.drop(name).schema.fields, T.StructField(name, kind)])


def encode(frame: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Every row with the token ids of its text in ``out``, an array of integers.

    ``path`` is a byte-level BPE file of the tokenizers library, which must have neither a normalizer nor a prefix
    space; the ids are those that the library gives without special tokens around the text.  The file's own special
    tokens are taken as such where a text has them.

    A null or empty text has no ids.  Texts of any length are encoded whole.  Repeated rows are each encoded.  All columns stay; one called as ``out`` is replaced.  An empty table
    gives an empty result.
    """
    vocabulary = _sent(frame, path)
    rows = frame.withColumn(text, whole(text)).drop(out) if out != text else frame.withColumn(text, whole(text))
    schema = _with(rows, out, T.ArrayType(T.IntegerType()))
    kept = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(vocabulary.value.special)
        for batch in batches:
            for at, n, data, offsets in pieces(batch, text):
                part = batch.slice(at, n)
                token, first = encode_rows(vocabulary.value, splitter, data, offsets)
                ids = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(token, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), ids], names=[*kept, out])

    return rows.mapInArrow(run, schema)


def decode(frame: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Every row with the text of its token ids in ``out``, special tokens included.

    Bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary and null ids are passed over, as the library
    does.  A null or empty list gives an empty text.  All columns stay; one called as ``out`` is replaced.
    """
    vocabulary = _sent(frame, path)
    rows = frame.drop(out) if out != ids else frame
    schema = _with(rows, out, T.StringType())
    kept = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(vocabulary.value.bytes, pa.binary())
        size = np.diff(np.frombuffer(names.buffers()[1], np.int32))
        for batch in batches:
            for part in _slices(batch, ids):
                lists = part.column(ids)
                flat = lists.flatten()
                row = np.repeat(np.arange(len(lists)), np.diff(_bounds(lists)))
                token = flat.fill_null(-1).to_numpy(zero_copy_only=False)
                known = (token >= 0) & (token < len(names))
                token, row = token[known], row[known]
                data = _gather(names, token)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, size[token], len(lists)))]).astype(np.int64)
                texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, out]
                )

    return rows.mapInArrow(run, schema)


def _bounds(lists: pa.ListArray) -> np.ndarray:
    """Where each list begins in the flattened values; null lists are empty."""
    size = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(size)])


def _gather(names: pa.Array, token: np.ndarray) -> bytes:
    """The bytes of all tokens, one after the other."""
    taken = names.take(pa.array(token))
    offsets = np.frombuffer(taken.buffers()[1], np.int32)
    return taken.buffers()[2].to_pybytes()[offsets[0] : offsets[len(token)]]


def _slices(batch: pa.RecordBatch, ids: str, tokens: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut between rows into parts of about so many tokens."""
    bounds = _bounds(batch.column(ids))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + tokens, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
