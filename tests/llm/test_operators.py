"""The training-data operators against brute force on small tables with every kind of odd row."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nearspan.llm import (
    decontaminate,
    mixing,
    near,
    privacy,
    quality,
    repeats,
    scoring,
    secrets,
    sharding,
    wrappers,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size long, measured int, _ string"
WORD = r"[^\x20\x09-\x0D]+"
TOKEN = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"


def prose(seed, n, words=300):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{rng.zipf(1.3) % words}x" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = prose(1, 400)
    changed = base.split()
    changed[200:205] = ["other"] * 5
    texts = [
        base,
        base,
        " ".join(changed),
        prose(2, 300) + " " + base[300:1500] + " " + prose(3, 100),
        "ab " * 600,
        "x" * 3000,
        "",
        None,
        "one",
        "Ünïcode wörds öf a shört text\nline\nline\n",
        prose(4, 3000),
        f"Write to jo.do@mail7.example.com or +1 (212) 555-0100 from 10.1.2.3, pay 4539578763621486. {prose(5, 80)}",
        f'{prose(6, 90)} token = "{TOKEN}" {prose(7, 30)}',
        " \t\n ",
    ]
    out = [(i, t, "en", ("a", "b", None)[i % 3], i, "c", 1, 2, "z") for i, t in enumerate(texts)]
    out.append(out[0])
    out.append((None, base, None, None, None, None, None, None, None))
    return out


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(WORD, text or "")


def lowered(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]


@pytest.mark.parametrize("most", [2, 4096])
@pytest.mark.parametrize("width,gram", [(400, 128), (40, 16)])
def test_repeats(documents, rows, width, gram, most):
    windows = Counter()
    for r in rows:
        data = (r[1] or "").encode()
        windows.update(data[p : p + width] for p in range(len(data) - width + 1))
    want = Counter()
    for r in rows:
        data = (r[1] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - width + 1):
            if windows[data[p : p + width]] > 1:
                gone[p : p + width] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        want[r[0], len(data), len(data) - len(kept), int((gone[1:] < gone[:-1]).sum()), kept] += 1
    r = F.col("repeats")
    out = repeats.without_repeats(documents, width, gram, most).select("doc_id", "id", *(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept")))
    assert Counter((x[0], x[2], x[3], x[4], bytes(x[5])) for x in out.collect()) == want


def test_suffix_sort_orders_suffixes():
    rng = np.random.default_rng(0)
    buffer = rng.integers(97, 99, 3000, dtype=np.uint8)
    begin, size = np.array([0, 700, 701]), np.array([700, 1, 900])
    places = rng.permutation(2000)[:1601]
    suffixes = repeats.Suffixes(buffer, 60)
    got = suffixes.mergesort(places, begin, size)
    for b, s in zip(begin, size):
        texts = [buffer[p : p + 60].tobytes() for p in got[b : b + s]]
        assert texts == sorted(texts) and sorted(got[b : b + s]) == sorted(places[b : b + s])


def test_quality(documents, rows):
    def features(text):
        text = text or ""
        w = words(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if words(x)]
        return (
            len(w),
            sum(map(len, w)),
            sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)),
            len(hit),
            len(lines),
        )

    got = quality.measure(documents).select("doc_id", "text", "measured.*").collect()
    for r in got:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
        assert tuple(r[n] for n in names) == features(r["text"])
    kept = Counter(r["doc_id"] for r in got if r["rejected_by"] is None)
    assert Counter(r[0] for r in quality.keep_good(documents).select("doc_id").collect()) == kept
    backwards = quality.rejected_by(F.col("text"), list(reversed(quality.RULES))).isNull()
    assert documents.filter(F.col("text").isNotNull() & backwards).count() == sum(kept.values())


def test_secrets(spark, documents):
    found = [(r["doc_id"], r["value"]) for r in secrets.scan(documents).collect()]
    assert found == [(12, TOKEN)]
    lines = []
    for i in range(300):
        digest = hashlib.sha1(str(i).encode()).hexdigest()
        lines.append((i, f"{prose(i, 20)} api_key: '{digest}' /usr/share/lib{i}/module/file{i}/long.txt wordwordwordwordword{i % 7}"))
    train = spark.createDataFrame(lines, "doc_id long, text string")
    got = {r["value"] for r in secrets.scan(train).collect()}
    assert got == {hashlib.sha1(str(i).encode()).hexdigest() for i in range(300)}


def test_secret_forest_on_held_out_labels(spark):
    lines = [
        (i, f'{prose(i, 10)} password="{hashlib.md5(str(i).encode()).hexdigest()}" commit {"deadbeef" * 4} and {i:020d}')
        for i in range(400)
    ]
    docs = spark.createDataFrame(lines, "doc_id long, text string")
    found = secrets.candidates(docs, secrets.transitions(docs), secrets.dictionary(docs))
    truth = found.withColumn("label", (F.length("value") == 32).cast("double") * (F.col("value") != "deadbeef" * 4).cast("double"))
    model = secrets.fit(truth.filter("doc_id < 200"), fit_rows=100)
    judged = secrets.judged(truth.filter("doc_id >= 200"), model)
    right = judged.agg(F.avg(((F.col("probability") >= 0.5).cast("double") == F.col("label")).cast("double"))).first()[0]
    assert right > 0.99


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_feistel_is_a_permutation(n):
    numbers = np.arange(n)
    image = sharding.permute(numbers, n, 9)
    assert sorted(image) == list(numbers)
    assert (sharding.permute(image, n, 9, inverse=True) == numbers).all()
    assert n < 64 or (image != numbers).mean() > 0.9


def test_sharding(documents, rows):
    got = sharding.document_shards(documents, 3).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, sharding.document_shards(documents.repartition(5), 3).collect()), key=repr)
    order = sorted(got, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"]))
    row = sharding.source_row(got[0]["shard"], got[0]["slot"], len(got), 3, 20)
    assert order[row]["doc_id"] == got[0]["doc_id"]


def linked(sets, percent):
    """Smallest index of each set's component by comparing all pairs."""
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def shingles(text, n):
    w = lowered(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_groups(spark, shingle, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 3)
    monkeypatch.setattr(near, "PART", 4)
    rng = np.random.default_rng(shingle)
    texts = ["", None, "one", "ONE", "two words", prose(0, 40)]
    for family in range(4):
        base = prose(10 + family, 150, 3000).split()
        for _ in range(25):
            copy = list(base)
            for at in rng.integers(0, len(copy), rng.integers(0, 16 // shingle + 3)):
                copy[at] = f"edit{rng.integers(1000)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    roots = linked([shingles(t, shingle) for t in texts], 80)
    got = {r["doc_id"]: r for r in near.document_groups(docs, shingle).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == roots
    assert all(got[i]["n_shingles"] == len(shingles(t, shingle)) for i, t in enumerate(texts))
    assert all(got[i]["kept"] == (roots[i] == i) for i in got)
    assert len(set(roots)) > 10


def test_near_chains(spark):
    """Windows that slide over a long text: only neighbours are linked, and every chain is one group."""
    texts = []
    for chain in range(8):
        words = prose(50 + chain, 400, 5000).split()
        texts += [" ".join(words[at : at + 120]) for at in range(0, 250, 9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    roots = linked([shingles(t, 2) for t in texts], 80)
    got = {r["doc_id"]: r["component_id"] for r in near.document_groups(docs, 2).collect()}
    assert [got[i] for i in range(len(texts))] == roots


def test_near_odd_rows(documents, rows):
    got = near.document_groups(documents).collect()
    assert len(got) == len(rows)
    assert {r["component_id"] for r in got if r["doc_id"] in (0, 1, 2, None)} == {0}
    assert {r["component_id"] for r in got if r["doc_id"] in (6, 7, 13)} == {6, 7, 13}
    kept = near.one_of_each(documents)
    assert kept.columns == documents.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == [0, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]


def test_sketch_estimates_overlap():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for share in (0.5, 0.8, 0.9):
        a = pool[:1000]
        b = pool[int(1000 * (1 - share) / (1 + share)) :][:1000]
        x, y = near.sketch(a)[None], near.sketch(b)[None]
        assert (np.maximum(x, y)[0] == near.sketch(np.union1d(a, b))).all()
        guess = near.likely(x, y, np.array([1000]), np.array([1000]), 0.4)[0]
        assert abs(guess - share) < 0.12


def folded(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\v\f\r" else c for c in text or "")
    return np.array([ord(c) for c in text], np.int64)


def least_edits(item, text):
    """Fewest edits of any 80 characters of the item (the whole of a shorter one) against any part of the text."""
    width = min(len(item), 80)
    windows = np.lib.stride_tricks.sliding_window_view(item, width)
    columns = np.arange(len(text) + 1)
    row = np.zeros((len(windows), len(text) + 1), np.int64)
    for i in range(width):
        new = row + 1
        new[:, 1:] = np.minimum(new[:, 1:], row[:, :-1] + (windows[:, i : i + 1] != text))
        row = np.minimum.accumulate(new - columns, axis=1) + columns
    return int(row.min())


def test_decontamination(spark, documents):
    rng = np.random.default_rng(8)
    items = [(i, prose(100 + i, 25, 5000)) for i in range(6)] + [(6, "Short  one"), (7, None), (8, "tiny words of an item")]
    items += [(9, " \n"), (10, ""), (6, "Short  one"), (6, "tiny words of an item")]
    texts = []
    for i in range(40):
        passage = list(items[i % 6][1])
        for at in rng.integers(0, len(passage), rng.integers(0, 12)):
            passage[at] = "" if at % 3 else "qq"
        texts.append(prose(200 + i, 12) + "\n" + "".join(passage).upper() + " " + prose(300 + i, 12))
    texts += ["", None, prose(9, 50), items[8][1], "a short\n one.", "ashort  one", "SHORT\t ONE", "short  ones", "x" * 20000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, t in enumerate(texts):
        for item, text in items[:6] + [items[8], items[12]]:
            width = min(len(text), 80)
            edits = least_edits(folded(text), folded(t))
            if edits <= min(width * 6 // 100, width // 12 - 1):
                want[d, item] = edits
    want |= {(texts.index(t), 6): 0 for t in ("a short\n one.", "SHORT\t ONE")}
    found = decontaminate.passages(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in found} == want and len(found) == len(want)
    assert 20 < len(want) < 45 and {0, 1, 2, 3, 4} <= set(want.values())
    parted = decontaminate.passages(docs.repartition(5), bench, 200).collect()
    assert sorted(map(tuple, parted)) == sorted(map(tuple, found))
    for r in found:
        part = folded(texts[r["doc_id"]])[r["begin"] : r["end"]]
        text = next(t for i, t in items if i == r["item_id"] and (i != 6 or (t == "Short  one") == (len(part) < 12)))
        assert least_edits(folded(text), part) == r["edits"]
    clean = {r["doc_id"] for r in decontaminate.clean_documents(docs, bench).collect()}
    assert clean == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.clean_documents(documents, bench).columns == documents.columns


@pytest.mark.parametrize("edits", [0, 4])
def test_decontamination_at_every_offset(spark, edits):
    rng = np.random.default_rng(edits)
    item = prose(77, 60, 5000)
    texts = []
    for at in range(len(item) - 79):
        part = list(item[at : at + 80])
        for place in rng.choice(80, edits, replace=False):
            part[place] = "~" if place % 2 else ""
        texts.append(prose(1000 + at, 10) + "".join(part) + prose(2000 + at, 10))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["doc_id"]: r for r in decontaminate.passages(docs, bench).collect()}
    assert set(found) == set(range(len(texts))) and all(r["edits"] <= edits for r in found.values())


def test_mixing(spark, documents, rows):
    got = mixing.mix(documents).select(*documents.columns, "mixed").collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = dict(zip(names, (5, 2, 1)))
    target, left, live = {}, 1.5 * sum(sizes.values()), list(names)
    while live:
        level = left / sum(weight[s] for s in live)
        over = [s for s in live if level * weight[s] > 2 * sizes[s]]
        target |= {s: 2.0 * sizes[s] for s in over} if over else {s: level * weight[s] for s in live}
        left -= sum(2 * sizes[s] for s in over)
        live = [s for s in live if s not in over] if over else []
    taken, seen = Counter(), defaultdict(set)
    for r in got:
        m = r["mixed"]
        assert m["size"] == len(words(r["text"])) and m["source_size"] == sizes[r["source"]]
        assert abs(m["target"] - target[r["source"]]) < 1e-6
        assert sum(p["words"] for p in m["pieces"]) <= 2 * m["size"]
        taken[r["source"]] += sum(p["words"] for p in m["pieces"])
        for p in m["pieces"]:
            seen[r["source"], p["number"]].add(p["shard"])
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 20 for s in names)
    assert all(len(s) == 1 for s in seen.values()), "a block belongs to one shard"
    again = mixing.mix(documents.repartition(7)).select("doc_id", "mixed").collect()
    assert sorted((repr(r["doc_id"]), repr(r["mixed"])) for r in again) == sorted((repr(r["doc_id"]), repr(r["mixed"])) for r in got)


def test_splitting_tree_meets_quotas(spark):
    quotas = [(0, 400), (1, 90), (2, 10), (3, 0), (4, 7)]
    frame = spark.createDataFrame(quotas, "number int, quota long")
    for shards in (1, 5, 8):
        got = mixing.split_quotas(frame, shards, 3).collect()
        per_source, per_leaf = Counter(), Counter()
        for r in got:
            assert r["quota"] >= 0
            per_source[r["number"]] += r["quota"]
            per_leaf[r["leaf"]] += r["quota"]
        assert dict(per_source) == dict(quotas)
        assert sorted(per_leaf) == list(range(shards)) and max(per_leaf.values()) - min(per_leaf.values()) <= shards.bit_length() + 1


def test_hypergeometric_draws(spark):
    draws = spark.range(4000).select(
        mixing.hypergeometric(F.lit(50), F.lit(20), F.lit(10), (F.col("id") + 0.5) / 4000).alias("x")
    )
    mean, spread = draws.agg(F.avg("x"), F.var_pop("x")).first()
    assert abs(mean - 4) < 0.01 and abs(spread - 10 * 0.4 * 0.6 * 40 / 49) < 0.02


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for number, pattern in enumerate(BASE.values()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if number == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if number == 2:
                total = sum(d if k % 2 == 0 else (2 * d - 9 * (d > 4)) for k, d in enumerate(reversed(digits)))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if number == 3 and not 8 <= len(digits) <= 15:
                continue
            found.append((number, m.start(), m.end()))
    return found


def test_base_spans_match_the_patterns():
    rng = np.random.default_rng(4)
    letters = list("ab1.@+-9 ()2_%ü\n")
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 40)))
        assert privacy.base_spans(text) == plain_spans(text)
    for text in ("a@b.c_d@e.f", "1.2.3.4.5", "256.1.1.1", "00000000010.1.1.1", "4539 5787-6362 1486", "x@y", "a" * 50_000 + "@"):
        assert privacy.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("sent", [0, 1000])
def test_disclosing_terms(spark, sent):
    person = "kim@mail1.example.org"
    rows = [(i, f"{prose(i, 30)} the zebrakeeper wrote {person} the {prose(i + 50, 30)}") for i in range(4)]
    rows += [(10 + i, f"the {prose(i + 90, 60)}") for i in range(30)] + [(50, ""), (51, None), (None, "the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in privacy.find_all(docs, sent).collect()}
    for i in range(4):
        text = rows[i][1]
        terms = {text[t["begin"] : t["end"]] for t in found[i]["disclosing"]}
        assert terms == {"zebrakeeper", "wrote"}
    assert all(not r["disclosing"] for d, r in found.items() if d is None or d > 3)
    clean = {r["doc_id"]: r["sanitised"] for r in privacy.sanitise(docs).collect()}
    assert "zebrakeeper" not in clean[0] and person not in clean[0] and "[email]" in clean[0]
    assert clean[10] == rows[4][1] and clean[51] == ""


@pytest.mark.parametrize("sent", [0, 1_000_000])
def test_terms_disclose_wherever_they_stand(spark, sent):
    far, common = prose(70, 20, 40), [f"c{i}" for i in range(40)]
    rows = [(i, f"Zebrakeeper {far} wrote ü zebrakeeper to ann@mail1.example.org {far} {far}") for i in range(4)]
    rows += [(100 + i, f"{far} c{i % 40}") for i in range(250)] + [(90, f"{far} c3 ü ZEBRAKEEPER c1")]
    rows += [(91, f"{far} {' '.join(common)} okapi@mail2.example.org {far} quagga"), (92, f"{far} quagga c2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in privacy.find_all(docs, sent).collect()}
    marked = {d: [rows[k][1][t["begin"] : t["end"]] for t in found[d]["disclosing"]] for k, (d, _) in enumerate(rows)}
    # Far from the entity, in a text without it, and beside an entity of one document.
    assert all(marked[i].count("zebrakeeper") == marked[i].count("Zebrakeeper") == 1 for i in range(4))
    assert "ZEBRAKEEPER" in marked[90] and marked[92] == ["quagga"] and "quagga" in marked[91]
    assert not any(marked[100 + i] for i in range(250))
    clean = {r["doc_id"]: r["sanitised"].lower() for r in privacy.sanitise(docs).collect()}
    assert not any("zebrakeeper" in text or "quagga" in text for text in clean.values())


def test_personal_data_of_odd_rows(documents, rows):
    got = privacy.document_personal_data(documents).collect()
    assert len(got) == len(rows)
    names = list(BASE)
    for r in got:
        text = next(x[1] for x in rows if x[0] == r["doc_id"]) or ""
        listed = ",".join(f"{names[k]}:{b}:{e}" for k, b, e in plain_spans(text))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and r["spans"].startswith(listed)
        assert [r[f"n_{n}"] for n in names] == [sum(k == i for k, _, _ in plain_spans(text)) for i in range(4)]


@pytest.mark.parametrize("chunk,bucket", [(1 << 22, 1 << 24), (900, 700)])
def test_scores_are_those_of_the_automaton(documents, rows, chunk, bucket):
    """Against an automaton that is walked token by token."""
    tokens = [(r[0], lowered(r[1]) + ["</s>"]) for r in rows]
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in tokens}
    count, pairs = Counter(), Counter()
    for d, t in tokens:
        if not held[d]:
            count.update(t)
            pairs.update(zip(["<s>"] + t, t))
    total, distinct = sum(count.values()), len(count)
    starts = count["</s>"]

    def walk(text, weight):
        state, score = "<s>", 0.0
        for token in text:
            size = starts if state == "<s>" else count[state]
            root = (count[token] + 1) / (total + distinct + 1)
            if pairs[state, token]:
                score += log10((pairs[state, token] + weight * root) / (size + weight))
            else:
                score += log10(weight / (size + weight)) + log10(root)
            state = token
        return score

    got = scoring.score_documents(documents, chunk, bucket).collect()
    assert len(got) == len(rows)
    by_id = dict(tokens)
    fits = []
    for weight in scoring.ROOT_WEIGHTS:
        fits.append(max(abs(r["score"] - walk(by_id[r["doc_id"]], weight)) for r in got))
    assert min(fits) < 1e-6
    for r in got:
        t = by_id[r["doc_id"]]
        base = sum(log10((count[x] + 1) / (total + distinct + 1)) for x in t)
        assert abs(r["base_score"] - base) < 1e-6 and r["held_out"] == held[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(count[x] > 0 for x in t), total)
    # The weights of a state sum to 1 over all tokens and one unknown.
    for state in ("<s>", "one", next(iter(count))):
        assert abs(sum(10 ** (walk([state, w], 8.0) - walk([state], 8.0)) for w in [*count, "never seen"]) - 1) < 1e-9


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a><li>x</ul></nav>"
    "<div class='ad'>Buy</div>%s<aside>Side</aside><div id='comments'><p>First!</div><footer>&copy; me</footer></body></html>"
)
PAGES = {
    "<article><h1>A &amp; B</h1><p>one\n  two<p>three <b>bold</b></article>": "A & B\none two\nthree bold",
    "<article><h1>X</h1><p>p</p><form>no</form><script>var t='</p>'</script><div class='newsletter-signup'>no</div></article>": "X\np",
    "<article><ul><li>1<li>2</ul><table><tr><td>a<td>b</table></article>": "1\n2\na\nb",
    "<article>5 &lt; 6 &nbsp; < 7<!-- not --></article>": "5 < 6 < 7",
    "<article><p>cut of": "cut of",
    "": "",
}


def test_pages(spark):
    rows = [(i, f"http://h{i % 2}.example.com/{i}", PAGE % body, "u") for i, body in enumerate(PAGES)]
    deep = "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>"
    rows += [(20, None, None, "u"), (21, "nonsense", "", "u"), (22, "http://h0.example.com/", deep, "u"), rows[0]]
    rows += [(23, "http://plain.example.com/", "<html><body><nav>n</nav><div><p>body text</p></div></body></html>", "u")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string").repartition(3)
    got = wrappers.page_texts(frame).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    for i, want in enumerate(PAGES.values()):
        assert text[i] == want
    assert text[20] == text[21] == "" and text[22] == "deep" and text[23] == "body text"
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_columns_of_any_name_survive_near_duplicates(spark):
    names = ["_id", "_key", "key", "id", "row", "group", "first", "node", "n_shingles", "row_id", "row_key"]
    text = prose(3, 80)
    rows = [(i, text if i < 3 else prose(10 + i, 60), *(f"{c}{i}" for c in names)) for i in range(6)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [r for r in rows if r[0] in (0, 3, 4, 5)]


def test_wrapper_has_slots_groups_and_options():
    a = wrappers.fold(wrappers.tree("<ul><li>a<li>b</ul><p>x</p>"))
    b = wrappers.fold(wrappers.tree("<ul><li>c</ul><h2>t</h2><p>y</p><p>z</p>"))
    merged = wrappers._merged(a, b)
    assert [(n.label, n.repeated, n.optional) for n in merged.children] == [("ul", False, False), ("h2", False, True), ("p", True, False)]
    assert [(n.label, n.repeated) for n in merged.children[0].children] == [("li", True)]
    assert wrappers.pack(wrappers.unpack(wrappers.pack(merged))) == wrappers.pack(merged)


def test_wrapper_groups_several_labels():
    a = wrappers.fold(wrappers.tree("<h2>a</h2><p>b</p><h2>c</h2><p>d</p><p>e</p><h2>f</h2><p>g</p>"))
    assert [(n.label, n.repeated) for n in a.children] == [("*h2|p", True)]
    assert [(n.label, n.repeated) for n in a.children[0].children] == [("h2", False), ("p", True)]
    merged = wrappers._merged(wrappers.fold(wrappers.tree("<h2>x</h2><p>y</p>")), a)
    assert [(n.label, n.repeated, n.optional) for n in merged.children] == [("*h2|p", True, False)]
    assert wrappers.pack(wrappers.unpack(wrappers.pack(merged))) == wrappers.pack(merged)


def test_pages_are_read_through_judged_slots(spark):
    """No name tells here: only what the host's pages have in common does."""
    links = "<div><a href='/1'>one more {0}</a><a href='/2'>another of {0}</a></div>"
    body = "<html><body><div>We are a shop since 1901</div>%s<div><h2>Parts</h2><p>{1}</p><h2>Steps</h2><p>{2}</p></div></body></html>" % links
    rows = [(i, "http://a.example.com/", body.format(f"n{i}", prose(i, 20), prose(i + 9, 20))) for i in range(5)]
    # Pages of one host with and without a main region; a teaser is no main region for a page's text.
    rows += [(10 + i, "http://b.example.com/", f"<div>{prose(i + 20, 30)}</div>") for i in range(2)]
    rows += [(20, "http://b.example.com/", "<div>beside</div><article>inside it is</article>")]
    rows += [(21, "http://b.example.com/", f"<div>{prose(30, 60)}</div><article>teaser</article>")]
    # Copies of a page are no evidence, and a host of links only keeps them.
    rows += [(30 + i, "http://c.example.com/", "<div><p>the same</p></div>") for i in range(4)] + [(35, "http://c.example.com/", "<div>else</div>")]
    rows += [(40, "http://d.example.com/", links.format("k"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in wrappers.page_texts(frame).collect()}
    assert all(got[i] == f"Parts\n{prose(i, 20)}\nSteps\n{prose(i + 9, 20)}" for i in range(5))
    assert all(got[10 + i] == prose(i + 20, 30) for i in range(2))
    assert got[20] == "inside it is" and got[21] == f"{prose(30, 60)}\nteaser"
    assert {got[30 + i] for i in range(4)} == {"the same"} and got[35] == "else"
    assert got[40] == "one more kanother of k"


ODD_PAGES = {
    "<article class='post has-comments'><p>one</p></article><p>outside</p>": "one",
    "<div class='content no-sidebar'><p>one</p></div>": "one",
    "<main id='content-with-widgets'><p>one</p></main><p>outside</p>": "one",
    "<article class='sidebar'><p>one</p></article>": "one",
    "<form action='x'><div class='site-footer'>imprint</div><article><p>one</p></article></form>": "one",
    "<div class='sidebar-right'><div class='ad'>x</div><p>one two three</p></div>": "one two three",
    "<article>a long article<div class='newsletter-signup'>no</div><div id='post-comments'>no</div></article>": "a long article",
    "<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p><noscript>seen</noscript><xmp><b>&lt;</xmp></article><noscript>no</noscript>": (
        "so x=1\nseen\n<b>&lt;"
    ),
    "<article><p>one</p><svg><path d='x'><p>two</p><math><p>three</p><iframe src='x'><p>four</p></article>": "one\ntwo\nthree\nfour",
    "<article><div class='entry-header'><h1>Title</h1></div><p>one</p></article>": "Title\none",
}


def test_names_take_no_article_away(spark):
    rows = [(i, f"http://odd{i}.example.com/", f"<html><body>{body}</body></html>") for i, body in enumerate(ODD_PAGES)]
    got = {r["page_id"]: r["text"] for r in wrappers.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(len(rows))] == list(ODD_PAGES.values())


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for frame in (
        repeats.document_repeats(empty),
        quality.measure(empty),
        quality.keep_good(empty),
        secrets.document_secrets(empty),
        sharding.document_shards(empty),
        near.document_groups(empty),
        near.one_of_each(empty),
        decontaminate.passages(empty, bench),
        decontaminate.clean_documents(empty, bench.limit(0)),
        mixing.mixed_documents(empty),
        mixing.mixed_rows(empty),
        privacy.document_personal_data(empty),
        privacy.sanitise(empty),
        scoring.score_documents(empty),
        wrappers.page_texts(pages),
    ):
        assert frame.collect() == []


def test_pipeline_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "source_mix", "shards"]
    kept = docs
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.settle(stage(spark, kept, sf_dir), name)
        results[name] = kept.collect()
        assert name == "shards" or kept.columns == docs.columns
    good = [r for r in docs.collect() if r["doc_id"] in {x["doc_id"] for x in results["quality_rules"]}]
    roots = linked([shingles(r["text"], 5) for r in sorted(good, key=lambda r: r["doc_id"])], 80)
    ids = sorted(r["doc_id"] for r in good)
    assert {ids[i] for i in set(roots)} == {r["doc_id"] for r in results["near_duplicates"]}
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not [r for r in results["decontamination"] if any(x in r["text"] for x in items)]
    mixed = Counter(r["doc_id"] for r in results["source_mix"])
    assert max(mixed.values()) <= 2 and set(mixed) <= {r["doc_id"] for r in results["decontamination"]}
    assert Counter(r["doc_id"] for r in results["shards"]) == mixed
    final = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(repr, final)) == sorted(map(repr, results["shards"]))
