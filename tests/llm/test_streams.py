"""Encoding, collocations and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nearspan.llm import bpe, collocations, periodic, queries
from nearspan.llm.bytesets import pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, ids string, phrase string, key string, runs int, decoded int, n long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, texts, langs=("en", "de", None, "und")):
    rows = [(i, t, langs[i % len(langs)], "x", "y", "z", 1, 2, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[0], (None, texts[0], None, *[None] * 6)], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


def encode(vocabulary, texts):
    out, splitter = [], bpe.Splitter(vocabulary.special)
    for _, _, data, offsets in pieces(pa.record_batch({"text": texts}), "text", 4000):
        ids, first = bpe.encode_rows(vocabulary, splitter, data, offsets)
        out += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    return out


PARTS = (
    " |  |a|e|the|ing|'|'s|'re|'ll|'ve|'r| '|v|l|1|00|é|—|’|中文|࢏|🙂|é|՘|<|endoftext|>|\n|\t| |\x1c|\x85|​|　|aaaa|----|=|A"
).split("|") + ["<|endoftext|>", "<|endo", "|"]


def odd_texts(seed, n):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    chars = [lambda: rng.randrange(1, 0xD800), lambda: rng.randrange(0xE000, 0x110000), lambda: rng.randrange(32, 127)]
    texts += ["".join(chr(rng.choice(chars)()) for _ in range(30)) for _ in range(n // 4)]
    texts += ["".join(rng.choice("abet ") for _ in range(rng.randint(0, 200))) for _ in range(n // 4)]
    return [*texts, "", "x" * 500, "ab" * 400, " " * 300, "\n" * 65]


@pytest.mark.parametrize("seed", range(8))
def test_encoding_is_the_library_s(vocabulary, library, seed):
    texts = odd_texts(seed, 400)
    assert encode(vocabulary, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_character_is_split_as_the_library_does(vocabulary, library):
    marks = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{chr(c)}1{chr(c)}!{chr(c)}  {chr(c)}b" for c in marks[i : i + 64]) for i in range(0, len(marks), 1024)]
    assert encode(vocabulary, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_pair_is_compatible_if_the_library_keeps_it(vocabulary, library):
    rng = np.random.default_rng(4)
    usable = [t for t, b in enumerate(vocabulary.bytes[:50256]) if re.fullmatch(rb"[a-z]+", b)]
    left, right = rng.choice(usable, 20000), rng.choice(usable, 20000)
    joined = [(vocabulary.bytes[a] + vocabulary.bytes[b]).decode() for a, b in zip(left, right)]
    kept = [e.ids == [a, b] for e, a, b in zip(library.encode_batch(joined), left.tolist(), right.tolist())]
    assert vocabulary.compatible(left, right).tolist() == kept and 0 < sum(kept) < len(kept)


def test_only_failing_words_are_merged(vocabulary, monkeypatch):
    words = ["the", " internationalisation", "enterth"]
    seen = []
    merged = vocabulary.merged
    monkeypatch.setattr(vocabulary, "merged", lambda token, owner: seen.extend(set(owner.tolist())) or merged(token, owner))
    data = np.frombuffer("".join(words).encode(), np.uint8)
    vocabulary.encode_words(data, np.cumsum([0, *map(len, words)]))
    greedy, owner = vocabulary.propose(data, np.array([0, 3, 24]), np.array([3, 24, 31]))
    failing = {
        int(w) for w in set(owner.tolist())
        if not vocabulary.compatible(greedy[owner == w][:-1], greedy[owner == w][1:]).all()
    }
    assert set(seen) == failing


def test_long_words_and_queued_merges(vocabulary):
    rng = random.Random(1)
    for size in (1, 2, 63, 64, 65, 300):
        word = bytes(rng.choice(b"aabet") for _ in range(size))
        token = vocabulary.byte_tokens[np.frombuffer(word, np.uint8)]
        assert vocabulary.merged(token, np.zeros(size, np.int64))[0].tolist() == vocabulary.merged_long(token.tolist())


def test_encode_and_decode_frames(spark, library):
    texts = [*odd_texts(99, 60), None]
    rows = frame(spark, texts)
    coded = bpe.encode(rows, PATH)
    assert [c for c in rows.columns if c != "ids"] + ["ids"] == coded.columns
    want = Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in rows.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in coded.collect()) == want
    back = bpe.decode(coded, PATH).collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in back) == Counter((r["doc_id"], r["text"] or "") for r in rows.collect())


def test_decoding_any_ids(spark, library):
    rng = random.Random(2)
    lists = [[rng.randrange(50257) for _ in range(rng.randint(0, 30))] for _ in range(200)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows, PATH).collect()}
    assert [got[i] for i in range(len(lists))] == [library.decode(x, skip_special_tokens=False) for x in lists]
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 64, -5, 90000, 65])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in bpe.decode(odd, PATH).collect()} == {1: "", 2: "", 3: "ab"}


def plain_runs(words, least_words=24, least_periods=3):
    out = []
    for q in range(1, len(words) // least_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            if len(run) >= max(least_words, least_periods * q) and j > i:
                if not any(run[d:] == run[:-d] for d in range(1, q)):
                    out.append((i, len(run), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rng, size):
    words, kinds = [], rng.choice([1, 2, 3, 5, 20])
    while len(words) < size:
        if rng.random() < 0.6:
            unit = [rng.randrange(kinds) for _ in range(rng.randint(1, rng.choice([2, 5, 20, 40])))]
            words += (unit * rng.randint(2, 6))[: rng.randint(len(unit), 6 * len(unit))]
        else:
            words += [rng.randrange(kinds + 3) for _ in range(rng.randint(1, 10))]
    return words


@pytest.mark.parametrize("least", [(24, 3), (6, 3), (2, 3), (10, 4), (7, 5)])
def test_runs_inside_a_task(least):
    rng = random.Random(sum(least))
    found = 0
    for _ in range(300):
        docs = [periodic_words(rng, rng.choice([0, 5, 30, 200])) for _ in range(rng.randint(1, 4))]
        first = np.cumsum([0, *map(len, docs)])
        codes = np.array([w for d in docs for w in d], np.int64)
        segments = periodic.split_by_frequency(codes, first[:-1], first[1:], *least)
        got = list(zip(*(x.tolist() for x in periodic.lag_scan(codes, *segments, *least))))
        want = [(s + f, n, q) for d, f in zip(docs, first.tolist()) for s, n, q in plain_runs(d, *least)]
        assert got == want
        found += len(want)
    assert found > 100


def test_segments_are_stable():
    words = [1, 2, 3, 9, 1, 2, 3, 8, 1, 2, 4, 5] * 2 + [4] * 30 + [7] + [1] * 10
    codes = np.array(words)
    begin, end = periodic.split_by_frequency(codes, np.array([0]), np.array([len(words)]), 24, 3)
    assert len(begin)
    for a, b in zip(begin, end):
        assert min(Counter(words[a:b]).values()) >= 3 and b - a >= 24


def plain_periodic(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_periodic_query(spark, sf_dir, tmp_path):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rng = random.Random(8)
    texts = [" ".join(f"wé{w}" for w in periodic_words(rng, 120)) for _ in range(120)]
    rows = frame(spark, [*texts, None, "", " \n", "a " * 24, "a " * 23, "a\x0bb\x0c" * 5000])
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    for folder in (str(tmp_path), sf_dir):
        docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
        got = queries.op13_periodic_runs(spark, folder)
        assert got.columns == names
        assert Counter(tuple(r) for r in got.collect()) == Counter(plain_periodic(r["doc_id"], r["text"]) for r in docs)


def plain_collocations(rows, least=10, top=2000, percent=50):
    counts, totals = {}, Counter()
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            seen = counts.setdefault(lang or "und", Counter())
            totals[lang or "und"] += len(words)
            for size in (1, 2, 3):
                seen.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            if any(100 * b >= percent * a for q, b in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


@pytest.mark.parametrize("least, top, percent", [(10, 2000, 50), (2, 15, 50), (3, 2000, 100), (2, 2000, 1)])
def test_collocations(spark, least, top, percent):
    rng = random.Random(least + top)
    parts = ["New york", "new", "York", "city", "of", "the", "\x01", "é", "🙂", ",", ".", "\n", "\t", "\r", "of the city", "a", "a"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(120)]
    rows = frame(spark, [*texts, None, "", ".,;", "the " * 2000])
    got = collocations.collocations(rows, least, top, percent).collect()
    want = plain_collocations([(r["lang"], r["text"]) for r in rows.collect()], least, top, percent)
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 10


def test_collocations_don_t_depend_on_the_layout(spark, monkeypatch):
    rows = frame(spark, [" ".join(f"w{(i * j) % 17}" for j in range(60)) for i in range(50)])
    first = sorted(map(tuple, collocations.collocations(rows.coalesce(1), 3).collect()))
    # A bitmap in which every pair is marked only costs rows.
    monkeypatch.setattr(collocations, "_bitmap", lambda pairs: np.full(collocations.FILTER_BITS // 64, ~np.uint64(0)))
    assert first == sorted(map(tuple, collocations.collocations(rows.repartition(7), 3).collect()))


def test_scores_pass_64_bits(spark):
    cases = [(10**13, 10**13, 10**13), (10**13 - 1, 10**13, 10**13 - 3), (3 * 10**12, 7 * 10**12 + 1, 9 * 10**12), (10, 10, 10), (7, 9, 11)]
    rows = spark.createDataFrame(cases, "a long, l long, r long")
    got = rows.select("a", "l", "r", collocations._score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert all(s == 10**6 * a * a // (x * y) for a, x, y, s in got)


def test_empty_tables_of_streams(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.decode(bpe.encode(empty, PATH), PATH).collect() == []
    assert collocations.collocations(empty).collect() == []
    assert periodic.periodic_runs(empty).collect() == []
