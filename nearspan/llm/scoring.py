"""Language-model scores of whole texts by a weighted backoff automaton.

The model is a smoothed bigram automaton.  Its states are the root, the begin of a text and every token
of the training texts; a state has an arc for each token that followed it, and a failure arc to the
root for the others.  The root knows every token, and one more arc for all unknown ones.  With ``m`` as
weight of the root, ``c`` as counts in training texts and ``p`` as the root's probability,

* the arc of ``w`` from state ``v`` weighs ``(c(v w) + m * p(w)) / (c(v) + m)``,
* the failure arc of ``v`` weighs ``m / (c(v) + m)``,
* the root's arc weighs ``p(w) = (c(w) + 1) / (N + V + 1)``, with no count for unknown tokens,

so that the weights of each state sum to 1.  ``m`` is the one of ``ROOT_WEIGHTS`` under which the
training tokens are likeliest, each scored with its own occurrence left out.

No task ever holds the model.  Texts stand in chunks; a chunk asks for the counts of the tokens and
pairs that it contains, buckets of keys add up what all chunks have, and every chunk gets the counts of
its own keys back, from which it builds its part of the automaton and scores its texts.  Buckets grow
in number with the text, and a pair weighs the same in a bucket however often it occurs.

Tokens are words, A-Z lower-cased, and an end after the last; they are told apart by 64-bit hashes.
A null text has no words, so its only token is the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.llm.bytesets import mix, pieces, word_hashes
from nearspan.llm.common import settle, whole

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
ROOT_WEIGHTS = (0.5, 2.0, 8.0, 32.0, 128.0, 512.0, 2048.0, 1e5)
END, BEGIN = np.uint64(0x1234567), np.uint64(0x7654321)


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, like places of all together."""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return pa.compress(np.ascontiguousarray(flat.T).tobytes(), codec="zstd", asbytes=True)


def stretch(packed: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(packed, decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


class Tokens:
    """Tokens of the texts of a chunk, their states, and the sorted distinct tokens and pairs."""

    def __init__(self, text: bytes, sizes: np.ndarray) -> None:
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        buffer = np.frombuffer(text, np.uint8)
        counts, found = [], []
        batch = pa.record_batch([pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)])], ["text"])
        for _, _, part, bounds in pieces(batch, piece_bytes=1 << 20):
            hashes, first = word_hashes(part, bounds)
            counts.append(np.diff(first))
            found.append(hashes)
        counts = np.concatenate([*counts, np.zeros(0, np.int64)])
        self.counts = counts + 1
        ends = np.cumsum(self.counts)
        self.row = np.repeat(np.arange(len(counts)), self.counts)
        words = np.ones(int(self.counts.sum()), bool)
        words[ends - 1] = False
        token = np.full(len(words), END, np.uint64)
        token[words] = np.concatenate([*found, np.zeros(0, np.uint64)])
        state = np.empty_like(token)
        state[1:] = token[:-1]
        state[ends - self.counts] = BEGIN
        self.tokens, self.token = np.unique(token, return_inverse=True)
        self.pairs, self.pair = np.unique(mix(state * np.uint64(0x9E3779B97F4A7C15) + token), return_inverse=True)
        # The state after the begin is known as often as texts end.
        state[ends - self.counts] = END
        self.state = np.searchsorted(self.tokens, state)

    def keys(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        return (self.pairs, self.pair) if kind else (self.tokens, self.token)


def _chunks(documents: DataFrame, chunk_bytes: int) -> DataFrame:
    """``chunk, ids, held_out, sizes, text``: documents in chunks of about ``chunk_bytes`` of text."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    rows = documents.select("doc_id", held.alias("held_out"), whole("text").alias("text"))
    names = ["chunk", "ids", "held_out", "sizes", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for at, n, buffer, offsets in pieces(batch, piece_bytes=chunk_bytes):
                held.append((batch.slice(at, n), np.diff(offsets), buffer.tobytes()))
                size += len(buffer)
                if size >= chunk_bytes:
                    yield pack(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield pack(number, held)

    def pack(number: int, held: list[tuple]) -> pa.RecordBatch:
        ids = pa.concat_arrays([h[0].column("doc_id") for h in held])
        out = pa.concat_arrays([h[0].column("held_out") for h in held])
        ends = pa.array([0, len(ids)], pa.int32())
        sizes = np.concatenate([h[1] for h in held]).astype(np.int64)
        text = b"".join(h[2] for h in held)
        blob = len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)
        lists = [pa.ListArray.from_arrays(ends, ids), pa.ListArray.from_arrays(ends, out)]
        rest = [pa.array([sizes.tobytes()], pa.binary()), pa.array([blob], pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, *rest], names)

    schema = f"chunk long, ids array<{kind}>, held_out array<boolean>, sizes binary, text binary"
    return rows.mapInArrow(run, schema)


def _tokens(row: dict) -> tuple[Tokens, np.ndarray]:
    blob, sizes = row["text"], np.frombuffer(row["sizes"], np.int64)
    text = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    return Tokens(text, sizes), np.array(row["held_out"], bool)


def _asked(chunks: DataFrame, buckets: int) -> DataFrame:
    """``kind, bucket, chunk, n, keys, counts``: what each chunk asks of each bucket, keys in order."""
    names = ["kind", "bucket", "chunk", "n", "keys", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, held_out = _tokens(row)
                trained = ~held_out[tokens.row]
                for kind in (0, 1):
                    keys, index = tokens.keys(kind)
                    counts = np.bincount(index[trained], minlength=len(keys)).astype(np.uint32)
                    for bucket, begin, end in _cuts(keys, buckets):
                        gaps = np.diff(keys[begin:end], prepend=np.uint64(0))
                        yield pa.RecordBatch.from_pylist(
                            [dict(zip(names, (kind, bucket, row["chunk"], end - begin, squeeze(gaps), squeeze(counts[begin:end]))))],
                            pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]),
                        )

    return chunks.select("chunk", "held_out", "sizes", "text").mapInArrow(
        run, "kind int, bucket long, chunk long, n long, keys binary, counts binary"
    )


def _cuts(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """Sorted keys cut into buckets, ranges of equal width; empty ones are left out."""
    bounds = np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)
    edges = np.append(np.searchsorted(keys, bounds), len(keys))
    for bucket in np.flatnonzero(np.diff(edges)):
        yield int(bucket), int(edges[bucket]), int(edges[bucket + 1])


def _answered(asked: DataFrame) -> DataFrame:
    """``kind, bucket, chunk, n, counts, total, distinct``: each chunk's keys with their sums over all chunks.

    ``total`` and ``distinct`` of a bucket stand in the row of one chunk of it and are 0 in the others.
    """

    def add(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_numpy()
        keys = np.concatenate([np.cumsum(stretch(k, n, np.uint64), dtype=np.uint64) for k, n in zip(table.column("keys").to_pylist(), sizes)])
        counts = np.concatenate([stretch(c, n, np.uint32) for c, n in zip(table.column("counts").to_pylist(), sizes)])
        known, index = np.unique(keys, return_inverse=True)
        sums = np.bincount(index, weights=counts, minlength=len(known)).astype(np.uint64)
        ends = np.cumsum(sizes)
        replies = [squeeze(sums[index[e - n : e]]) for e, n in zip(ends, sizes)]
        total, distinct = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        total[0], distinct[0] = int(sums.sum()), int((sums > 0).sum())
        kept = table.select(["kind", "bucket", "chunk", "n"])
        for name, values in (("counts", pa.array(replies, pa.binary())), ("total", pa.array(total)), ("distinct", pa.array(distinct))):
            kept = kept.append_column(name, values)
        return kept

    schema = "kind int, bucket long, chunk long, n long, counts binary, total long, distinct long"
    return asked.groupBy("kind", "bucket").applyInArrow(add, schema)


class Automaton:
    """The part of the automaton that a chunk needs: counts of its tokens, states and pairs."""

    def __init__(self, tokens: Tokens, token_counts: np.ndarray, pair_counts: np.ndarray, total: int, distinct: int):
        self.token = token_counts[tokens.token].astype(float)
        self.state = token_counts[tokens.state].astype(float)
        self.pair = pair_counts[tokens.pair].astype(float)
        self.total, self.distinct = total, distinct

    def root(self, left_out: int = 0) -> np.ndarray:
        return (self.token - left_out + 1) / (self.total - left_out + self.distinct + 1)

    def walk(self, weight: float, left_out: int = 0) -> np.ndarray:
        """log10 weight of every step, from the state before a token over its arc, or failing to the root.

        The state before a token is the token before it, whatever the weights are, so the steps of all
        texts are taken together.  A state that the training texts don't have is the root.
        """
        state, pair = self.state - left_out, self.pair - left_out
        root = self.root(left_out)
        arc = np.log10(np.where(pair > 0, (pair + weight * root) / (state + weight), 1.0))
        failing = np.log10(weight / (state + weight)) + np.log10(root)
        return np.where(pair > 0, arc, failing)


def _scored(chunks: DataFrame, answers: DataFrame, total: int, distinct: int) -> DataFrame:
    """Per document its counts, its base score, and for each root weight its score and left-out score."""
    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double,"
        " scores array<double>, left_out array<double>"
    )

    def score(texts: pa.Table, replies: pa.Table) -> pa.Table:
        row = texts.to_pylist()[0]
        tokens, held_out = _tokens(row)
        counts = [np.zeros(len(tokens.keys(k)[0]), np.uint64) for k in (0, 1)]
        given = sorted(replies.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        for k in (0, 1):
            parts = [stretch(r["counts"], r["n"], np.uint64) for r in given if r["kind"] == k]
            counts[k] = np.concatenate([*parts, counts[k][:0]])
        machine = Automaton(tokens, *counts, total, distinct)
        n = len(tokens.counts)

        def sums(values: np.ndarray) -> np.ndarray:
            return np.bincount(tokens.row, weights=values, minlength=n)

        scores = np.stack([sums(machine.walk(w)) for w in ROOT_WEIGHTS], axis=1)
        trained = ~held_out[tokens.row]
        loo = np.stack([sums(np.where(trained, _finite(machine, w, trained), 0.0)) for w in ROOT_WEIGHTS], axis=1)
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * len(ROOT_WEIGHTS))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (scores, loo)]
        plain = [pa.array(held_out), pa.array(tokens.counts.astype(np.int64)), pa.array(sums(machine.token > 0).astype(np.int64))]
        ids = texts.column("ids").combine_chunks().values
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "scores", "left_out"]
        return pa.table([ids, *plain, pa.array(sums(np.log10(machine.root()))), *lists], names)

    left = chunks.groupBy("chunk")
    right = answers.select(F.col("chunk").alias("asker"), "kind", "bucket", "n", "counts").groupBy("asker")
    return left.cogroup(right).applyInArrow(score, schema)


def _finite(machine: Automaton, weight: float, trained: np.ndarray) -> np.ndarray:
    """Left-out scores; only training tokens have an occurrence to leave out."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(trained, machine.walk(weight, 1), 0.0)


def score_documents(documents: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    Documents whose ``crc32(doc_id) mod 7`` is 2 are held out; a null id counts as an empty text.
    Repeated rows are trained on and scored one by one.  An empty table gives no rows.
    """
    chunks = settle(_chunks(documents, chunk_bytes), "chunks")
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    answers = settle(_answered(_asked(chunks, max(1, -(-size // bucket_bytes)))), "answers")
    token_rows = answers.filter("kind = 0")
    total, distinct = token_rows.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    scored = settle(_scored(chunks, answers, total, distinct), "scored")
    sums = scored.agg(*(F.sum(F.col("left_out")[i]) for i in range(len(ROOT_WEIGHTS)))).first()
    best = max(range(len(ROOT_WEIGHTS)), key=lambda i: (sums[i] or 0.0, -i))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        F.col("scores")[best].alias("score"),
    )
