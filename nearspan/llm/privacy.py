"""Personal data and the terms that disclose it, by information-theoretic sanitisation.

Entities are e-mail addresses, IPv4 addresses, payment cards and phone numbers, found by form.  A term
of a document with an entity discloses it if it tells much of what there is to know: with document
frequencies over the whole corpus, the information of an entity is ``IC(c) = -log2 p(c)``, and a term gives
away ``PMI(c, t) = log2 p(c, t) / (p(c) p(t))`` of it.

Terms are all words of a document, with A-Z lower-cased.  A term that stands within ``REACH`` words of the
entity in ``SUPPORT`` documents is rated by the documents they share.  Other terms may share one by chance,
so one is taken off.  What is in one document only can't be told so; there a term is rated by its own
rarity, as if it had one document more: ``log2(N / (n + 1)) / log2 N``.

A term that gives away ``REMOVE`` of the information or more is removed, one that gives away ``GENERALISE``
or more is replaced by a word for its kind, wherever it stands in any text.  Positions are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.llm.bytesets import pieces, word_hashes, words
from nearspan.llm.common import WORD, settle, text_key, whole

REACH = 5
SUPPORT = 2
GENERALISE = 0.8
REMOVE = 0.95
SENT_TERMS = 1_000_000
KINDS = ("email", "ip", "card", "phone", "term")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that starts inside a run of digits would also start at the run's begin, so only begins are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses; every ``@`` is looked at once, so long runs cost no more."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        else:
            done = at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, begin, end)`` of the personal data in a text, by kind and then by place."""
    found = [(0, *span) for span in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def _before(text: str, at: int) -> list[tuple[int, int]]:
    """The ``REACH`` words that end before a place."""
    found = []
    while len(found) < REACH:
        while at > 0 and text[at - 1] in " \t\n\x0b\x0c\r":
            at -= 1
        end = at
        while at > 0 and text[at - 1] not in " \t\n\x0b\x0c\r":
            at -= 1
        if at == end:
            break
        found.append((at, end))
    return found


def _near(text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """Words on both sides of a span that don't touch it."""
    while begin > 0 and text[begin - 1] not in " \t\n\x0b\x0c\r":
        begin -= 1
    after = []
    for m in _WORD.finditer(text, end):
        if m.start() > end:
            after.append(m.span())
        if len(after) == REACH:
            break
    return _before(text, begin) + after


def _hash_words(words: list[str]) -> np.ndarray:
    data = [w.encode("utf-8", "replace") for w in words]
    offsets = np.cumsum([0, *(len(d) for d in data)])
    return word_hashes(np.frombuffer(b"".join(data), np.uint8), offsets)[0].view(np.int64)


def find_base(documents: DataFrame) -> DataFrame:
    """``doc_id, key, spans, entities, terms, near`` of every document of ``doc_id`` and ``text``.

    ``spans`` are ``(kind, begin, end)``.  Documents that have some also have the distinct hashes of their
    ``entities``, of all other words (``terms``), and of what stands ``near``: ``(entity, term)``.  The key
    is a digest of the text.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    filled = whole("text")
    rows = documents.select("doc_id", text_key(filled).alias("key"), filled.alias("text"))
    span = pa.struct([("kind", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())])
    pair = pa.struct([("entity", pa.int64()), ("term", pa.int64())])
    types = {"spans": pa.list_(span), "entities": pa.list_(pa.int64()), "terms": pa.list_(pa.int64()), "near": pa.list_(pair)}

    def one(text: str) -> tuple[list, list, list, list]:
        spans = base_spans(text)
        if not spans:
            return [], [], [], []
        free = _outside([m.span() for m in _WORD.finditer(text)], spans)
        free = [(b, e) for b, e in free if any(c.isalnum() for c in text[b:e])]
        hashes = dict(zip(free, map(int, _hash_words([text[b:e] for b, e in free])))) if free else {}
        entities, near = set(), set()
        for number, begin, end in spans:
            entity = int.from_bytes(hashlib.blake2b(f"{number}:{text[begin:end]}".encode(), digest_size=8).digest(), "little", signed=True)
            entities.add(entity)
            near |= {(entity, hashes[place]) for place in _near(text, begin, end) if place in hashes}
        named = [dict(zip(("kind", "begin", "end"), s)) for s in spans]
        return named, sorted(entities), sorted(set(hashes.values())), [{"entity": c, "term": t} for c, t in sorted(near)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(text) for text in batch.column("text").to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(types.values())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *columns], ["doc_id", "key", *types])

    schema = (
        f"doc_id {kind}, key binary, spans array<struct<kind:int,begin:long,end:long>>, entities array<long>,"
        " terms array<long>, near array<struct<entity:long,term:long>>"
    )
    return rows.mapInArrow(run, schema)


def _outside(places: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The places, in order, that no span overlaps."""
    taken: list[list[int]] = []
    for begin, end in sorted((b, e) for _, b, e in spans):
        if taken and begin <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([begin, end])
    out, at = [], 0
    for begin, end in places:
        while at < len(taken) and taken[at][1] <= begin:
            at += 1
        if at == len(taken) or end <= taken[at][0]:
            out.append((begin, end))
    return out


def _document_frequencies(documents: DataFrame, terms: DataFrame, sent_terms: int) -> DataFrame:
    """``term, n``: in how many documents each of the terms occurs.

    Up to ``sent_terms`` terms (8 bytes each) are sent to the tasks, which count these alone; beyond
    that all words are counted.  Both give the same counts.
    """
    wanted = None
    if terms.count() <= sent_terms:
        wanted = np.sort(terms.toArrow().column(0).to_numpy())

    def counts(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, first = word_hashes(buffer, offsets)
        hashes, row = hashes.view(np.int64), np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        if wanted is not None:
            rank = np.minimum(np.searchsorted(wanted, hashes), max(len(wanted) - 1, 0))
            known = wanted[rank] == hashes if len(wanted) else np.zeros(len(hashes), bool)
            hashes, row = hashes[known], row[known]
        order = np.lexsort((row, hashes))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        return np.unique(hashes[new], return_counts=True)

    def rows(values: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values), pa.array(numbers.astype(np.int64))], ["term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(wanted) if wanted is not None else 0, np.int64)
        for batch in batches:
            for _, _, buffer, offsets in pieces(batch):
                values, numbers = counts(buffer, offsets)
                if wanted is None:
                    yield rows(values, numbers)
                else:
                    sums[np.searchsorted(wanted, values)] += numbers
        yield rows(wanted[sums > 0] if wanted is not None else sums, sums[sums > 0])

    counted = documents.select(whole("text").alias("text")).mapInArrow(run, "term long, n long")
    return settle(counted.groupBy("term").agg(F.sum("n").alias("n")), "frequencies").join(terms, "term")


def disclosures(documents: DataFrame, found: DataFrame, sent_terms: int = SENT_TERMS) -> DataFrame:
    """``term, share``: the largest part of an entity's information that a term gives away.

    Frequencies count documents, copies included.  Entities of the same documents are rated as one.  Only
    terms at or above the thresholds are returned.
    """
    total = float(max(found.count(), 1))
    docs = found.filter(F.size("entities") > 0).groupBy("key")
    docs = docs.agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("entities", "terms", "near")))
    docs = settle(docs, "holders")
    names = settle(docs.select(F.explode("terms").alias("term")).distinct(), "terms")
    frequencies = settle(_document_frequencies(documents, names, sent_terms).withColumnRenamed("n", "n_term"), "rarity")

    holders = docs.select("key", "copies", F.explode("entities").alias("entity"))
    where = F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("where")
    entities = settle(holders.groupBy("entity").agg(F.sum("copies").alias("n_entity"), where), "entities")
    # A term in more documents than this is below the threshold even if all documents of the entity have it.
    most = F.col("n_entity") * F.pow(total / F.col("n_entity"), F.lit(1 - GENERALISE)) * 1.0001
    alike = entities.filter("n_entity > 1").groupBy("n_entity", "where").agg(F.min("entity").alias("group"))
    grouped = settle(entities.join(alike, ["n_entity", "where"]).select("entity", "n_entity", "group", most.alias("most")), "alike")
    asked = holders.join(grouped, "entity").groupBy("key", "copies", "group", "n_entity", "most").agg(F.count("*")).drop("count(1)")
    limit = grouped.agg(F.max("most")).first()[0] or 0.0
    rare = frequencies.filter(F.col("n_term") <= limit)
    terms = docs.select("key", F.explode("terms").alias("term")).join(rare, "term")
    both = asked.join(terms, "key").filter(F.col("n_term") <= F.col("most"))
    both = both.groupBy("group", "n_entity", "term", "n_term").agg(F.sum("copies").alias("both"))
    near = docs.select("key", "copies", F.explode("near").alias("t")).select("key", "copies", "t.*").join(grouped, "entity")
    near = near.groupBy("key", "copies", "group", "term").agg(F.count("*").alias("_")).groupBy("group", "term")
    near = near.agg(F.sum("copies").alias("n_near")).filter(F.col("n_near") >= SUPPORT)
    joint = both.join(near, ["group", "term"], "left")
    shown = F.col("both") - F.when(F.col("n_near").isNull(), 1).otherwise(0)
    information = F.log2(F.lit(total) / F.col("n_entity"))
    given = F.log2(shown * total / (F.col("n_entity") * F.col("n_term")))
    told = joint.filter(shown > 0).select("term", F.when(information > 0, given / information).otherwise(0.0).alias("share"))

    once = holders.join(entities.filter("n_entity = 1"), "entity").select("key").distinct()
    once = docs.join(once, "key", "left_semi").select(F.explode("terms").alias("term")).distinct().join(frequencies, "term")
    rarity = F.log2(total / (F.col("n_term") + 1)) / F.log2(F.lit(total))
    once = once.select("term", F.when(F.lit(total > 1), rarity).otherwise(0.0).alias("share"))
    rated = told.unionByName(once).filter(F.col("share") >= GENERALISE)
    return settle(rated.groupBy("term").agg(F.max("share").alias("share")), "rated")


def _marked(documents: DataFrame, rated: DataFrame, sent_terms: int) -> DataFrame:
    """``key, disclosing`` of every text with rated terms: all their places outside of personal data.

    Up to ``sent_terms`` rated terms are sent to the tasks; beyond that all words are joined with them.
    """
    sent = None
    if rated.count() <= sent_terms:
        table = rated.toArrow()
        hashes, shares = table.column("term").to_numpy(), table.column("share").to_numpy()
        order = np.argsort(hashes)
        sent = hashes[order], shares[order]
    rows = documents.select(text_key(whole("text")).alias("key"), whole("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, buffer, offsets in pieces(batch):
                begin, end, firsts = words(buffer, offsets)
                hashes = word_hashes(buffer, offsets)[0].view(np.int64)
                row = np.repeat(np.arange(n), np.diff(firsts))
                kept, shares = np.arange(len(hashes)), np.zeros(len(hashes))
                if sent is not None:
                    rank = np.minimum(np.searchsorted(sent[0], hashes), max(len(sent[0]) - 1, 0))
                    kept = np.flatnonzero(sent[0][rank] == hashes) if len(sent[0]) else kept[:0]
                    shares = sent[1][rank[kept]] if len(kept) else shares[:0]
                if not len(kept):
                    continue
                # Bytes to code points, counted from the begin of the row.
                points = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
                base = points[offsets[row[kept]]]
                places = list(zip((points[begin[kept]] - base).tolist(), (points[end[kept]] - base).tolist()))
                cuts = np.flatnonzero(np.diff(row[kept])) + 1
                for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kept)]):
                    at = first + int(row[kept[lo]])
                    free = set(_outside(places[lo:hi], base_spans(batch.column("text")[at].as_py())))
                    held = [k for k in range(lo, hi) if places[k] in free]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column("key")[at].as_py()] * len(held), pa.binary()),
                            pa.array([places[k][0] for k in held], pa.int64()),
                            pa.array([places[k][1] for k in held], pa.int64()),
                            pa.array(hashes[kept[held]] if held else [], pa.int64()),
                            pa.array(shares[held] if held else [], pa.float64()),
                        ],
                        ["key", "begin", "end", "term", "share"],
                    )

    found = rows.mapInArrow(run, "key binary, begin long, end long, term long, share double")
    if sent is None:
        found = found.drop("share").join(rated, "term")
    found = found.groupBy("key", "begin", "end").agg(F.max("share").alias("share"))
    return found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("begin", "end", "share"))).alias("disclosing"))


def find_all(documents: DataFrame, sent_terms: int = SENT_TERMS) -> DataFrame:
    """``doc_id, key, spans, disclosing`` of every document; ``disclosing`` are ``(begin, end, share)`` of terms.

    Null texts count as empty; repeated rows give repeated rows and count as documents of their own.
    """
    found = settle(find_base(documents), "personal")
    rated = disclosures(documents, found, sent_terms)
    lists = settle(_marked(documents, rated, sent_terms), "disclosing")
    joined = found.select("doc_id", "key", "spans").join(lists, "key", "left")
    return joined.withColumn("disclosing", F.coalesce("disclosing", F.array().cast(lists.schema["disclosing"].dataType)))


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents with ``sanitised``: the text without personal data and without what discloses it.

    Entities become ``[email]``, ``[ip]``, ``[card]`` or ``[phone]``; disclosing terms become ``[word]`` or
    ``[number]``, or go altogether.  Of overlapping spans the earlier one wins.  Columns ``sanitised``
    is replaced; ``_key`` is reserved.
    """
    marks = find_all(documents.select("doc_id", "text")).select(F.col("key").alias("_key"), "spans", "disclosing")
    marks = marks.filter("size(spans) > 0 OR size(disclosing) > 0").dropDuplicates(["_key"])
    marks = marks.select("_key", F.struct("spans", "disclosing").alias("_marks"))
    rows = documents.drop("sanitised").withColumn("_key", text_key(whole("text")))

    @F.udf("string")
    def apply(text: str, found) -> str:
        text = text or ""
        if found is None:
            return text
        edits = [(s["begin"], s["end"], f"[{KINDS[s['kind']]}]") for s in found["spans"]]
        for t in found["disclosing"]:
            general = "[number]" if any(c.isdigit() for c in text[t["begin"] : t["end"]]) else "[word]"
            edits.append((t["begin"], t["end"], "" if t["share"] >= REMOVE else general))
        parts, at = [], 0
        for begin, end, by in sorted(edits):
            if begin >= at:
                parts += [text[at:begin], by]
                at = end
        return "".join(parts) + text[at:]

    return rows.join(marks, "_key", "left").withColumn("sanitised", apply("text", "_marks")).drop("_key", "_marks")


def _listed(spans: Column) -> Column:
    named = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":",
            F.get(F.array(*map(F.lit, KINDS)), s["kind"]),
            s["begin"].cast("string"),
            s["end"].cast("string"),
        ),
    )
    return F.array_join(named, ",")


def _of_kind(kind: int) -> Column:
    return F.size(F.filter("spans", lambda span: span["kind"] == kind))


def document_personal_data(documents: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms`` of every document."""
    rows = find_all(documents.select("doc_id", "text"))
    counts = [_of_kind(k).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)]
    terms = F.transform("disclosing", lambda t: F.struct(F.lit(4).alias("kind"), t["begin"].alias("begin"), t["end"].alias("end")))
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat("spans", terms)).alias("spans"),
        F.size("disclosing").cast("long").alias("n_terms"),
    )
