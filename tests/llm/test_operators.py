"""The training-data operators against brute force, on small tables with every awkward case."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from siltstone.llm import components, decontamination, exact_dedup, licences, minhash, mixing, pii, quality, queries, runindex, sharding, simhash, suffix_dedup, toxicity

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def awkward() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, repeated rows, near copies."""
    rnd = random.Random(1)
    words = ["alpha", "Beta", "gamma,", "the", "of", "é", "naïve", "x", " y"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 5, 40, 200]))) for _ in range(12)]
    rows = [(None, None, None, None, None), (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \t\n", "en", None, 3), (3, " \t\n", "en", None, 3), (None, "null id", None, "b", 1)]
    for i in range(60):
        text = rnd.choice(base)
        if i % 3 == 0:
            text += rnd.choice([" ", "\n", " z", " alpha"])
        rows.append((rnd.randrange(4, 60), text, rnd.choice(["en", None]), rnd.choice(["a", "b", "c", "é", None]), len(text)))
    # licences whole, wrapped, cut, edited, repeated and among other text
    for i, (_, texts) in enumerate(sorted(licences.TEMPLATES.items())):
        for j, t in enumerate(texts):
            cut = t.split()
            del cut[:: 12 - j]
            rows.append((100 + i, t, "en", "b", None))
            rows.append((200 + i, rnd.choice([t.upper(), f"x y\n\n{t}\n \n{t}", " ".join(cut), t.replace(" ", "\n", 2), f"{base[j]}\n{t} {base[0][:20]}"]), None, "a", 1))
    rows += [(90, "long " * 20_000, "en", "a", 1), (91, "long " * 20_000, "en", "a", 1), (92, base[3], "en", "a", 1), (92, base[3], "en", "a", 1)]
    return rows


ROWS = awkward()


@pytest.fixture(scope="module")
def docs(spark):
    """With extra columns whose names clash with those the operators use."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in ("score", "kept", "slot", "key", "id", "fp", "h", "size", "Kept_ID", "turn", "quality_score", "mix_key")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# --- op1 -----------------------------------------------------------------------------------------


def brute_repeats(rows, length):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, 1 << 63), 1 << 63 if i is None else i)
    out = []
    for i, t in rows:
        b, k = (t or "").encode(), 1 << 63 if i is None else i
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < k:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("length", "block", "judged", "frequent", "task"), [(50, 8_000_000, 32_000_000, 20_000, 16_000_000), (50, 3_000, 9_000, 20_000, 500), (20, 5_000, 700, 10, 2_000)])
def test_repeats(docs, monkeypatch, length, block, judged, frequent, task):
    for name, value in (("BLOCK", block), ("JUDGED", judged), ("FREQUENT", frequent), ("TASK", task)):
        monkeypatch.setattr(suffix_dedup, name, value)
    assert rows_of(suffix_dedup.remove_repeats(docs, length)) == brute_repeats([(r[0], r[1]) for r in ROWS], length)


def test_repeats_of_ids_of_any_size(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"{k} {text} {k}") for k, i in enumerate([None, (1 << 63) - 1, (1 << 63) - 1, (1 << 63) - 2, None, -(1 << 63) + 2, 1 << 62])] + [((1 << 63) - 1, "q" * 70), (None, "q" * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(suffix_dedup.remove_repeats(docs)) == brute_repeats(rows, 50)
    assert rows_of(suffix_dedup.remove_repeats(docs.where("doc_id IS NULL OR doc_id > 9223372036854775806"))) == brute_repeats([r for r in rows if r[0] is None or r[0] == (1 << 63) - 1], 50)


def test_repeats_with_text(docs, none):
    rows = suffix_dedup.remove_repeats(docs, with_text=True).collect()
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in rows)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_run_index():
    rnd = random.Random(5)
    for _ in range(150):
        alphabet = rnd.choice([b"ab", b"abc\x00", bytes(range(256))])
        base = bytes(rnd.choice(alphabet) for _ in range(60))
        texts = [bytes(rnd.choice(alphabet) for _ in range(rnd.randint(0, 6))) + base[(a := rnd.randrange(60)) : a + rnd.randint(0, 40)] for _ in range(rnd.randint(0, 12))]
        ix, length = runindex.RunIndex(texts), rnd.choice([1, 3, 9])
        seen, want, at = {}, [], 0
        for t in texts:
            want += [seen.setdefault(t[i : i + length], at + i) if i + length <= len(t) else at + i for i in range(len(t))]
            at += len(t)
        assert ix.first_occurrence(length).tolist() == want
        pattern = bytes(rnd.choice(alphabet) for _ in range(rnd.randint(1, 4)))
        assert ix.count(pattern) == sum(t[i:].startswith(pattern) for t in texts for i in range(len(t)))


def test_matching_statistics():
    """Neighbour and shared length of every suffix, in texts that share much, little, or end alike."""
    rnd = random.Random(6)
    for _ in range(300):
        letters = rnd.choice([b"a", b"ab", bytes(range(97, 123)), bytes(range(256))])
        texts = [bytes(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 2, 3, 7, 20, 130]))) for _ in range(rnd.randint(1, 9))]
        texts += [t[rnd.randint(0, len(t)) :] * rnd.choice([1, 3]) for t in texts if rnd.random() < 0.5]
        data = b"".join(texts)
        end = [e for t, e in zip(texts, itertools.accumulate(map(len, texts)), strict=True) for _ in t]
        neighbour, match = runindex.RunIndex(texts).statistics()
        order = sorted(range(len(data)), key=lambda i: ([256 + c for c in data[i : end[i]]] + [end[i] - len(data)]))
        for before, i in zip([-1, *order], order, strict=False):
            assert neighbour[i] == before or match[i] == 0
            same = 0
            while before >= 0 and max(i - end[i], before - end[before]) + same < 0 and data[i + same] == data[before + same]:
                same += 1
            assert match[i] == same


def test_run_index_compresses_repetition():
    rnd = random.Random(2)
    text = bytes(rnd.randrange(97, 123) for _ in range(400))
    assert runindex.RunIndex([text] * 50).runs < 3 * 400


# --- op2 -----------------------------------------------------------------------------------------


def edit_distance_in(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_decontamination_against_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([3, 8, 14, 30])))) for i in range(12)] + [(50, ""), (51, None), (None, "no id here at all")]
    rows = [(0, None), (1, ""), (2, " ".join(t for _, t in items if t))]
    for d in range(3, 120):
        words = rnd.choice(items[:12])[1].split()
        for _ in range(rnd.randint(0, len(words) // 4)):
            at = rnd.randrange(len(words))
            words[at : at + rnd.randint(0, 1)] = [rnd.choice([*vocabulary, "odd"])] * rnd.randint(0, 1)
            words = words or ["odd"]
        around = [[rnd.choice([*vocabulary, "filler", "other"]) for _ in range(rnd.randint(0, 40))] for _ in range(2)]
        rows.append((d, " ".join(around[0]) + ". " + ", ".join(words).upper() + "\n" + " ".join(around[1])))
    got = decontamination.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {}
    for d, t in rows:
        for i, item in items:
            if words := decontamination.words_of(item or ""):
                n = edit_distance_in(words, decontamination.words_of(t or ""))
                if n <= decontamination.edit_budget(len(words), 0.8):
                    want[d, i] = n
    found = {(r.doc_id, r.item_id): r.distance for r in got}
    assert found.items() <= want.items()  # every find is exact
    assert len(found) >= 0.99 * len(want)
    for r in got:
        text = dict(rows)[r.doc_id]
        assert edit_distance_in(decontamination.words_of(text[r.span_start : r.span_end]), decontamination.words_of(dict(items)[r.item_id])) <= r.distance


@pytest.mark.parametrize("n", [10, 30, 50, 100])
def test_recall_by_item_size(n):
    """Items edited at the full budget and planted in other text, each size on its own."""
    rnd = random.Random(n)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(n))) for i in range(20)]
    index = decontamination.Index(items, 0.8, 0.99)
    budget, found, trials = decontamination.edit_budget(n, 0.8), 0, 200
    for _ in range(trials):
        i, text = rnd.choice(items)
        words = text.split()
        for _ in range(budget):
            at, kind = rnd.randrange(len(words)), rnd.randrange(3)
            words[at : at + (kind > 0)] = [rnd.choice(vocabulary)] * (kind < 2)
        around = [[rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))] for _ in range(2)]
        found += i in {hit[0] for hit in index.search(" ".join(around[0] + words + around[1]))}
    assert found >= 0.99 * trials


def test_sizes_that_miss_the_recall_are_verified_place_by_place():
    items = [(1, " ".join(f"w{i}" for i in range(60)))]
    index = decontamination.Index(items, 0.8, 1.0, most=32)
    assert index.repetitions == {60: None}
    words = items[0][1].split()
    words[0:36:3] = ["x"] * 12
    assert index.search(" ".join(["a"] * 7 + words))[0][3] == 12


def test_benchmark_in_parts(docs, spark):
    bench = spark.createDataFrame([(i, f"alpha Beta {w} long long long {i}") for i, w in enumerate(["the", "of", "x", "gamma"])] + [(9, "long long long")], "item_id long, text string")
    whole = rows_of(decontamination.find_leaks(docs, bench))
    assert whole and rows_of(decontamination.find_leaks(docs, bench.unionByName(bench), max_items=2)) == whole
    assert rows_of(decontamination.keep_clean(docs, bench, max_items=2)) == rows_of(decontamination.keep_clean(docs, bench))


def test_decontamination_keeps_clean_rows(docs, none, spark):
    bench = spark.createDataFrame([(1, "alpha Beta never seen before")], "item_id long, text string")
    assert decontamination.keep_clean(docs, bench).count() == len(ROWS)
    assert decontamination.keep_clean(docs, spark.createDataFrame([(1, "long long long")], "item_id long, text string")).count() == len(ROWS) - 2
    assert decontamination.find_leaks(none, bench).count() == 0
    assert decontamination.find_leaks(docs, bench.where("false")).count() == 0


def test_walks_of_equal_windows_agree():
    rows = np.array([[1, 2, 3, 4], [1, 2, 3, 4], [2, 3, 4, 5]])
    walks = decontamination.cgk(rows, 8, np.arange(5))
    assert (walks[0] == walks[1]).all() and not (walks[0] == walks[2]).all()


# --- op3, op5 ------------------------------------------------------------------------------------


def tables(spark, sf="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_quality_on_held_out_rows(spark):
    docs, labels = tables(spark)
    rows = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_quality_edges(docs, none, spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None), (999, 1)], "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert quality.quality(none, labels).count() == 0
    assert {r.score for r in quality.quality(docs, labels.where("false")).collect()} == {0.5}
    assert quality.keep_good(docs, labels.where("false"), 0.4).columns == docs.columns


def test_vote_by_hand():
    """Every cosine, one by one; all that tie with the last neighbour vote; blocks make no difference."""
    rng = np.random.default_rng(3)
    known = [" ".join(rng.choice(["Foo", "bar.", "12", "x-y", "zzz", "QQ"], 40)).encode() for _ in range(30)]
    known += known[:12]  # ties
    y = rng.integers(0, 2, len(known))
    model = quality.Model(np.stack([quality.features(t) for t in known]), y, 8, 7)
    asked = [*known[:20], b"", b"a", *[" ".join(rng.choice(["Foo", "bar.", "12", "other", ";;"], 25)).encode() for _ in range(40)]]
    vector = lambda t: (quality.features(t) * model.idf).astype(float) @ model.basis
    want = []
    for t in asked:
        v, near = vector(t), []
        for k, label in zip(known, y, strict=True):
            u = vector(k)
            near.append((round(float(u @ v) / max(float(np.sqrt(u @ u) * np.sqrt(v @ v)), 1e-12), 9), int(label)))
        last = sorted(near, reverse=True)[6][0]
        voters = [(max(c, 0) ** 8, label) for c, label in near if c >= last]
        weight = sum(w for w, _ in voters)
        want.append(sum(w * label for w, label in voters) / weight if weight else float(y.mean()))
    x = np.stack([quality.features(t) for t in asked])
    for block in (512, 7, 1):
        assert np.allclose(model.scores(x, block), want, atol=2e-6)


def test_quality_ignores_held_out_labels(spark):
    docs, labels = tables(spark)
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    pick = ("doc_id", "score")
    assert rows_of(quality.quality(docs, labels), *pick) == rows_of(quality.quality(docs, flipped), *pick)


def test_labelled_rows_are_bounded(spark):
    """Rows that repeat a doc_id, and labels without a document, take up no places."""
    docs = spark.createDataFrame([(i % 8, f"text {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in [*range(8), *range(1000, 1200)]], "doc_id long, quality int")
    usable = {r.doc_id for r in labels.where(~quality.held_out()).collect() if r.doc_id < 8}
    for limit in (2, 100):
        rows = quality.labelled_rows(docs, labels, ["quality"], limit).collect()
        assert len(rows) == len({r.doc_id for r in rows}) == min(limit, len(usable))
        assert all(r.text == min(f"text {i}" for i in range(400) if i % 8 == r.doc_id) for r in rows)


def test_chain_learns_and_uses_earlier_categories(spark):
    rnd = random.Random(4)
    filler = [f"f{i}" for i in range(200)]
    texts, marks = [], []
    for _ in range(800):
        rude, threat = rnd.random() < 0.3, 0
        words = [rnd.choice(filler) for _ in range(30)]
        if rude:
            words.append(rnd.choice(["idiot", "moron"]))
            threat = int(rnd.random() < 0.5)
            if threat:
                words.append("hurt")
        elif rnd.random() < 0.2:
            words.append("hurt")  # harmless alone
        texts.append(" ".join(words).encode())
        marks.append((int(rude), threat))
    chain = toxicity.fit_chain(texts[:600], np.array(marks[:600]), ["rude", "threat"])
    p = chain.probabilities(texts[600:])
    y = np.array(marks[600:])
    assert ((p > 0.5) == y).mean(axis=0).min() > 0.95
    assert chain.weights[1][-2] > 0  # the earlier category's log-odds count


def test_chain_by_hand():
    """Scores from the weights, word by word; the model of a category learns from what folds without the row say of earlier ones."""
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["idiot!", "hurt", "Fine", "day", "the", "é"]) for _ in range(rnd.randint(0, 9))).encode() for _ in range(300)]
    marks = np.array([(b"idiot" in t, b"idiot" in t and b"hurt" in t) for t in texts], int)
    chain = toxicity.fit_chain(texts, marks, ["rude", "threat"])
    for t, p in zip(texts, chain.probabilities(texts), strict=True):
        words = {w for w in re.split(r"[^A-Za-z0-9é]+", t.decode().lower()) if w}
        z = []
        for weights in chain.weights:
            own = weights[: len(chain.vocabulary)]
            z.append(sum(own[chain.vocabulary[w.encode()]] for w in words if w.encode() in chain.vocabulary) + sum(a * max(-10, min(10, b)) for a, b in zip(weights[len(chain.vocabulary) : -1], z, strict=True)) + weights[-1])
        assert np.allclose(p, [1 / (1 + np.exp(-v)) for v in z])
    x = toxicity.Rows([chain.numbers(t) for t in texts], len(chain.vocabulary))
    none, fold = np.zeros((len(texts), 0)), np.arange(len(texts)) % 3
    unseen = np.zeros(len(texts))
    for f in range(3):
        w = toxicity.fit_linear(x, none, marks[:, 0].astype(float), (fold != f).astype(float))
        unseen[fold == f] = (x.times(w[:-1]) + w[-1])[fold == f]
    second = toxicity.fit_linear(x, np.clip(unseen, -10, 10)[:, None], marks[:, 1].astype(float), np.ones(len(texts)))
    assert np.allclose(second, chain.weights[1])


def test_toxicity_edges(docs, none, spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, labels, ["toxic"]).count() == len(ROWS)
    assert toxicity.toxicity(none, labels, ["toxic"]).count() == 0
    assert {r.p_toxic for r in toxicity.toxicity(docs, labels.where("false"), ["toxic"]).collect()} == {0.5}


# --- op4 -----------------------------------------------------------------------------------------


def test_lookup_table():
    names = sharding.shard_names(7)
    table = sharding.fill_table(names, 1009)
    shares = Counter(table)
    assert max(shares.values()) - min(shares.values()) <= 1
    fewer = sharding.fill_table(names[:-1], 1009)
    stayed = sum(a == b for a, b in zip(table, fewer, strict=True) if a != 6) / sum(a != 6 for a in table)
    assert stayed > 0.7
    # turn by turn, as the method says
    order = {s: [(sharding._number(n, "start") + j * (sharding._number(n, "stride") % 1008 + 1)) % 1009 for j in range(1009)] for s, n in enumerate(names)}
    want, turn = {}, 0
    while len(want) < 1009:
        want[next(x for x in order[turn % 7] if x not in want)] = turn % 7
        turn += 1
    assert [want[i] for i in range(1009)] == table
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 1009)
    with pytest.raises(ValueError, match="prime"):
        sharding.fill_table(names, 1000)


def test_shards(docs, none):
    names = sharding.shard_names(5)
    got = sharding.assign_shards(docs, names, 1009)
    assert got.columns == [*docs.columns, "_slot", "shard"]
    table = sharding.fill_table(names, 1009)
    for r in got.collect():
        key = "|".join([str(r.doc_id) if r.doc_id is not None else "\0", hashlib.md5((r.text or "").encode()).hexdigest()])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 1009
        assert (r["_slot"], r.shard) == (slot, names[table[slot]])
    assert sharding.assign_shards(none, names, 1009).count() == 0


# --- op6, op8, op9: SQL ---------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("which", ["awkward", "empty", "sf0.001"])
def test_against_sql(spark, tmp_path, name, which):
    place = DATA
    if which != "sf0.001":
        place = str(tmp_path)
        spark.createDataFrame(ROWS if which == "awkward" else [], SCHEMA).coalesce(1).write.parquet(f"{place}/documents.parquet")
    glob = f"{place}/documents.parquet" + ("/*.parquet" if which != "sf0.001" else "")
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{glob}'")
    got, want = queries.queries()[name](spark, place), c.sql(queries.oracle_sql()[name])
    pick = sorted(got.columns)
    assert pick == sorted(want.columns)
    if name == "op6_licences" and which == "awkward":
        assert got.where("licences IS NOT NULL").count() >= 40
    assert rows_of(got, *pick) == sorted((tuple(r) for r in want.select(*pick).fetchall()), key=repr)


def split_by_hand(hashes, capacity):
    """Extendible hashing as in the books: insert one by one, split the overfull bucket, double the directory where it must."""
    depth, directory, buckets = 0, [0], [(0, [])]  # (own depth, hashes)
    for h in hashes:
        while len(buckets[i := directory[h >> (64 - depth) if depth else 0]][1]) >= capacity:
            own, held = buckets[i]
            if own == depth:
                directory, depth = [b for b in directory for _ in (0, 1)], depth + 1
            bit = 64 - own - 1
            buckets[i] = (own + 1, [x for x in held if not x >> bit & 1])
            buckets.append((own + 1, [x for x in held if x >> bit & 1]))
            prefix = next(c for c, b in enumerate(directory) if b == i) >> (depth - own) if own else 0
            for c in range(len(directory)):
                if directory[c] == i and c >> (depth - own - 1) == prefix * 2 + 1:
                    directory[c] = len(buckets) - 1
        buckets[i][1].append(h)
    return depth, {h: own for own, held in buckets for h in held}


@pytest.mark.parametrize("capacity", [2, 40, 1000])
def test_directory_is_that_of_splitting_one_by_one(spark, capacity):
    rnd = random.Random(capacity)
    hashes = sorted({rnd.getrandbits(64) >> rnd.choice([0, 0, 2]) for _ in range(300)})
    rnd.shuffle(hashes)
    depth, own = split_by_hand(hashes, capacity)
    frame = spark.createDataFrame([(h - (1 << 64) if h >> 63 else h,) for h in hashes], "h long")
    directory = exact_dedup.build_directory(frame, capacity)
    assert directory.depth == depth
    local = {r.cell: (r.local, r.bucket) for r in directory.cells.collect()}
    for h in hashes:
        cell = h >> (64 - depth) if depth else 0
        assert local[cell] == (own[h], cell >> (depth - own[h]) << (depth - own[h]))
    assert directory.address(frame).count() == len(hashes)
    assert exact_dedup.build_directory(frame.where("false"), capacity).depth == 0


def test_directory_doubles_at_the_production_capacity(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    directory = exact_dedup.build_directory(docs.select(F.xxhash64(exact_dedup.normalised(F.col("text"))).alias("h")).distinct(), 500)
    assert directory.depth >= 4 and directory.cells.select("bucket").distinct().count() >= 16


def brute_groups(rows):
    """doc_id, keep_id, group_size, sha of each row, and how many rows of each group are kept."""
    by = defaultdict(list)
    for i, t in rows:
        by[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = [(i, min(g)[3], len(g), hashlib.sha256(n.encode()).hexdigest()) for n, g in by.items() for *_, i in g]
    return sorted(out, key=repr), len(by)


@pytest.mark.parametrize("case", ["plain", "collisions", "hot groups", "no broadcast"])
def test_exact_groups(docs, none, monkeypatch, case):
    from pyspark.sql import functions as F

    weak = lambda c: F.pmod(F.xxhash64(c), F.lit(5)) - 2
    if case == "hot groups":
        monkeypatch.setattr(exact_dedup, "HOT", 1)
        monkeypatch.setattr(exact_dedup, "HOT_GROUPS", 1 << 40)
    if case == "no broadcast":
        monkeypatch.setattr(exact_dedup, "CELLS", 0.001)
    rows = exact_dedup.exact_dedup(docs, 2, weak if case == "collisions" else F.xxhash64).collect()
    want, groups = brute_groups([(r[0], r[1]) for r in ROWS])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == want
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == groups and all(r.doc_id == r.keep_id for r in kept)
    if case == "collisions":  # different texts of one hash are told apart and chained
        assert max(r.chain for r in rows) >= groups / 5 - 1
    assert exact_dedup.exact_dedup(none).count() == 0


def test_mix_is_near_its_targets(docs):
    rows = mixing.mix(docs).collect()
    taken = defaultdict(int)
    for r, d in zip(sorted(rows, key=repr), sorted(rows, key=repr), strict=True):
        assert r.taken <= 3 * r.size and d == r
    by = {(r.source_size, r.target): 0 for r in rows}
    for r in rows:
        by[r.source_size, r.target] += r.taken
        taken[r.target] += 1
    for (size, target), n in by.items():
        assert abs(n - target) <= max(5, 0.05 * size)
    assert rows_of(mixing.mix(docs.repartition(7))) == rows_of(mixing.mix(docs))


def test_prefix_sums_over_partitions(spark):
    from pyspark.sql import functions as F

    from siltstone.llm.common import prefix_sums

    rnd = random.Random(9)
    rows = [(rnd.choice(["a", "b", None]), i, rnd.randrange(50)) for i in range(500)]
    frame = spark.createDataFrame(rows, "g string, i long, n long")
    got = {r.i: (r.before, r.place) for r in prefix_sums(frame.withColumn("one", F.lit(1).cast("long")), [F.col("i").asc()], {"before": "n", "place": "one"}, ["g"]).collect()}
    assert got == {i: (sum(x[2] for x in rows if x[0] == g and x[1] < i), sum(x[0] == g and x[1] < i for x in rows)) for g, i, _ in rows}
    assert {r.i: r.before for r in prefix_sums(frame, [F.col("i").asc()], {"before": "n"}).collect()} == {i: sum(x[2] for x in rows if x[1] < i) for _, i, _ in rows}


def test_targets_of_many_sources(spark):
    """Shares by weight, capped at three times the size, the excess shared again until none is above."""
    rnd = random.Random(10)
    sizes = {f"s{i:03d}": rnd.choice([0, 1, 7, 50, 400, 10_000]) for i in range(120)} | {None: 33}
    names = sorted(k for k in sizes if k) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, total = {}, float(sum(sizes.values()))
    while True:
        open_ = [s for s in names if s not in target]
        unit = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * unit > 3 * sizes[s]]
        if not over:
            target |= {s: weight[s] * unit for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert all(abs(r.target - target[r.source]) < 1e-6 for r in got) and len(got) == len(sizes)


def test_applied_mix(docs, none):
    got = mixing.apply_mix(docs)
    assert got.columns == docs.columns
    originals = {r[1] for r in ROWS}
    assert {r.text for r in got.collect()} <= originals
    assert mixing.apply_mix(none).count() == 0


def test_licence_anchors_are_safe():
    flat = licences.flat_templates(licences.TEMPLATES)
    anchors = licences.anchor_words(flat, 0.8)
    rnd = random.Random(7)
    for name, grams in flat:
        for _ in range(200):
            kept = [g for g in grams if rnd.random() < 0.75]
            if 2 * len(kept) / (len(kept) + len(grams)) >= 0.8:
                assert any(a in g for a in anchors for g in kept), name


# --- op7 -----------------------------------------------------------------------------------------


def slow_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(fps, budget):
    distinct = sorted(set(fps))
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= budget:
                parent[find(b)] = find(a)
    return {f: find(f) for f in distinct}


def test_near_duplicates(docs, none):
    got = simhash.near_duplicates(docs).collect()
    fps = [slow_fingerprint(r[1]) for r in ROWS]
    root = slow_components(fps, 2)
    least = {}
    for r, f in zip(ROWS, fps, strict=True):
        if r[0] is not None:
            least[root[f]] = min(least.get(root[f], r[0]), r[0])
    want = sorted(((r[0], f"{f:016x}", least.get(root[f])) for r, f in zip(ROWS, fps, strict=True)), key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    assert simhash.near_duplicates(none).count() == 0


def test_keep_one_of_each_group(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    root = slow_components([slow_fingerprint(r[1]) for r in ROWS], 2)
    assert sorted(Counter(root[slow_fingerprint(r.text)] for r in kept.collect()).values()) == [1] * len(set(root.values()))
    assert simhash.keep_one(none).count() == 0


@pytest.mark.parametrize("budget", [0, 1, 2, 4])
def test_trie_walk(budget):
    rng = np.random.default_rng(budget)
    flips = (np.uint64(1) << rng.integers(0, 64, (15, 20)).astype(np.uint64)) ^ rng.integers(0, 2**64, 15, dtype=np.uint64)[:, None]
    a = np.unique(np.concatenate([rng.integers(0, 2**64, 200, dtype=np.uint64), flips.ravel()]))
    close = lambda x, y: (int(x) ^ int(y)).bit_count() <= budget
    pairs = lambda x, nodes, **k: sorted((int(i), int(j)) for p, q in simhash.walk_pairs(x, np.array(nodes), budget, **k) for i, j in zip(p, q, strict=True))
    n, whole = len(a), [[0, len(a), 0, len(a)]]
    assert pairs(a, whole) == pairs(a, whole, chunk=50) == [(i, j) for i in range(n) for j in range(i + 1, n) if close(a[i], a[j])]
    b = np.concatenate((a[::2], a[1::2]))
    m = len(a[::2])
    assert pairs(b, [[0, m, m, n]]) == [(i, j) for i in range(m) for j in range(m, n) if close(b[i], b[j])]


@pytest.mark.parametrize(("budget", "capacity"), [(2, 131_072), (2, 3), (0, 5), (4, 10)])
def test_links_over_many_nodes(spark, budget, capacity):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    fps = sorted({int(x) for x in base} | {int(x) ^ 1 << int(b) for x in base for b in rng.integers(0, 64, 3)} | {int(x) ^ 1 << 63 ^ 1 << int(rng.integers(50, 63)) for x in base})
    fps = sorted({*fps, *[fps[0] ^ 1 << int(b) ^ 1 << int(c) for b, c in rng.integers(0, 64, (60, 2))]})  # a crowd around one
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    edges = simhash.fingerprint_links(frame, budget, capacity)
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    root = slow_components(fps, budget)
    group = defaultdict(set)
    for x in fps:
        group[got.get(signed(x), signed(x))].add(x)
    want = defaultdict(set)
    for x in fps:
        want[root[x]].add(x)
    assert sorted(map(sorted, group.values())) == sorted(map(sorted, want.values()))


def test_ids_of_any_size(spark):
    """No value of doc_id has a meaning of its own."""
    ids = [(1 << 62) + 5, (1 << 63) - 1, -(1 << 63), None, None, 7]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in zip(ids, ["a b c d", "a b c d", "q", "a b c d", "z z", "z z"], strict=True)], SCHEMA)
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(ids[0], ids[0]), (ids[1], ids[0]), (ids[2], ids[2]), (None, ids[0]), (None, 7), (7, 7)], key=repr)
    for kept in (simhash.keep_one(docs), minhash.keep_one(docs)):
        assert sorted(r.doc_id for r in kept.collect()) == sorted([ids[0], ids[2], 7])
    alone = docs.where("doc_id IS NULL")
    assert {r.component_id for r in simhash.near_duplicates(alone).collect()} == {None}
    assert minhash.keep_one(alone).count() == simhash.keep_one(alone.unionByName(alone)).count() == 2


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_component_rounds_compare_any_number_of_edges(spark):
    edges = spark.range(18_000_000).selectExpr("id AS u", "id + 1 AS v")  # a sum of 40-bit hashes of these passes a long
    state = components._state(edges)
    assert state[0] == 18_000_000
    assert state == components._state(edges.repartition(3)) != components._state(edges.replace(5, -5, "u"))


# --- near-duplicates by shingle similarity --------------------------------------------------------


def slow_shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def slow_groups(texts):
    """For each text the number of its group: components of the links of 5-word similarity 0.8 or more."""
    sets = [slow_shingles(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or (a and sets[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j])):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def near_copies():
    """Texts of 30 to 300 words with up to eight copies each, of similarities around 0.8."""
    rnd = random.Random(12)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = []
    for _ in range(60):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([30, 60, 120, 300]))]
        texts.append(" ".join(base))
        for _ in range(rnd.randint(0, 8)):
            words = list(base)
            for _ in range(rnd.randint(0, max(2, len(base) // 20))):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append("\n".join(words).upper() if rnd.random() < 0.2 else " ".join(words))
    return texts


def test_pipeline_drops_near_duplicates(spark):
    texts = [*near_copies(), *[r[1] for r in ROWS]]
    groups = slow_groups(texts)
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, DATA).collect()}
    assert not set(groups) - {groups[i] for i in kept}
    assert Counter(groups[i] for i in kept) == {g: 1 for g in groups}
    assert kept == set({g: i for i, g in reversed(list(enumerate(groups)))}.values())


@pytest.mark.parametrize(("limit", "value"), [("TILE", 2), ("SHINGLES", 300)])
def test_near_duplicates_over_many_tiles(spark, monkeypatch, limit, value):
    monkeypatch.setattr(minhash, limit, value)
    texts = near_copies()
    groups = slow_groups(texts)
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)
    assert [r.component for r in sorted(minhash.labelled(docs).collect())] == [min(j for j, h in enumerate(groups) if h == g) for g in groups]


def test_near_duplicates_delete_what_written_steps_shuffled(spark, monkeypatch):
    """Disk holds the shuffles of the step at work, not of all before it until the driver collects garbage."""
    files = lambda: {str(b) for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()) if str(b).startswith("shuffle_")}
    before, left = files(), [None]

    def links(pairs, sets, least, run=minhash._links):
        deadline = time.monotonic() + 5  # files go in the background
        while (now := files() - before) and time.monotonic() < deadline:
            time.sleep(0.1)
        left[:] = now
        return run(pairs, sets, least)

    monkeypatch.setattr(minhash, "_links", links)
    # the trie's own small steps keep theirs
    monkeypatch.setattr(minhash, "_trie_pairs", lambda classes, budget: classes.sparkSession.createDataFrame([], "u long, v long, nu long, nv long"))
    texts = near_copies()
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    groups = slow_groups(texts)
    assert [r.component for r in sorted(minhash.labelled(docs).collect())] == [min(j for j, h in enumerate(groups) if h == g) for g in groups]
    assert left == []


def test_pipeline_keeps_what_is_less_similar(spark):
    """Repeated lines settle a fingerprint, whatever else a text says; links below the similarity must not join groups either."""
    rnd = random.Random(13)
    word = lambda: f"v{rnd.randrange(10**6)}"
    line = [word() for _ in range(7)]  # odd, so that no bit is a tie
    texts = [" ".join(line * 60 + [word() for _ in range(30)]) for _ in range(10)]
    base = [word() for _ in range(200)]
    for n in (4, 6, 8):  # a run of n new words: 196 - n - 4 of 196 + n + 4 shingles stay; similarity 0.92, 0.90, 0.88
        texts.append(" ".join(base[:90] + [word() for _ in range(n)] + base[90 + n :]))
    for n in (20, 30, 60):  # 0.78, 0.70, 0.51
        texts.append(" ".join(base[:90] + [word() for _ in range(n)] + base[90 + n :]))
    texts.append(" ".join(base))
    fps = [slow_fingerprint(t) for t in texts]
    assert sum((a ^ b).bit_count() <= 4 for i, a in enumerate(fps[:10]) for b in fps[:i]) > 20
    groups = slow_groups(texts)
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, DATA).collect()}
    assert kept == set({g: i for i, g in reversed(list(enumerate(groups)))}.values())
    assert kept >= {*range(11), 13, 14, 15}


# --- op10 ----------------------------------------------------------------------------------------


def base_spans(text):
    found = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in pii.CARD.finditer(text) if 13 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and pii.luhn(d)]
    found += [("phone", *m.span()) for m in pii.PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


def test_base_detection_equals_the_patterns():
    rnd = random.Random(3)
    for _ in range(20_000):
        text = "".join(rnd.choice("a@.1+- (9é") for _ in range(rnd.randint(0, 40)))
        assert pii.detect(text) == base_spans(text)


DISGUISED = [
    ("write john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("mail jane at example dot org please", "email", "jane at example dot org"),
    ("john [at] example dot com", "email", "john [at] example dot com"),
    ("john at example [dot] com", "email", "john at example [dot] com"),
    ("john@example dot com", "email", "john@example dot com"),
    ("so john dot doe at example dot com", "email", "john dot doe at example dot com"),
    ("john(at)mail.example.com.", "email", "john(at)mail.example.com"),
    ("a<at>b<dot>de", "email", "a<at>b<dot>de"),
    ("escribe a ana arroba correo punto es", "email", "ana arroba correo punto es"),
    ("marie arobase poste point fr", "email", "marie arobase poste point fr"),
    ("kurt [at] post punkt de", "email", "kurt [at] post punkt de"),
    ("bob&#64;example&#46;com", "email", "bob&#64;example&#46;com"),
    ("bob%40example.com", "email", "bob%40example.com"),
    ("bob {@} example.com", "email", "bob {@} example.com"),
    ("аdmin@exаmple.com", "email", "аdmin@exаmple.com"),
    ("so ＢＯＢ＠ｅｘ．ｃｏｍ", "email", "ＢＯＢ＠ｅｘ．ｃｏｍ"),
    ("call +one four one five five five five two six seven one now", "phone", "+one four one five five five five two six seven one"),
    ("call plus four nine double five one two triple six, seven", "phone", "plus four nine double five one two triple six, seven"),
    ("llama a plus tres cuatro nueve uno dos ocho cero siete seis ya", "phone", "plus tres cuatro nueve uno dos ocho cero siete seis"),
    ("ruf plus vier neun fünf null eins zwo drei sechs sieben acht an", "phone", "plus vier neun fünf null eins zwo drei sechs sieben acht"),
    ("plus four nine 555 one two twenty three nineteen", "phone", "plus four nine 555 one two twenty three nineteen"),
    ("card four one one one 1111 one one one one 1111", "card", "four one one one 1111 one one one one 1111"),
    ("id 4​111 1111 1111 1111.", "card", "4​111 1111 1111 1111"),
    ("ip 10 (dot) 0 (dot) 0 (dot) 1 ok", "ip", "10 (dot) 0 (dot) 0 (dot) 1"),
    ("ip 10 dot 0 dot 0 dot 1 ok", "ip", "10 dot 0 dot 0 dot 1"),
    ("ip 10.0[.]0 dot 1 ok", "ip", "10.0[.]0 dot 1"),
]


@pytest.mark.parametrize(("text", "kind", "found"), DISGUISED)
def test_disguises(text, kind, found):
    base, spans = pii.find(text)
    assert [(k, text[a:b]) for k, a, b in spans if (k, a, b) not in base] == [(kind, found)]


def test_generated_disguises():
    """Addresses and numbers in random disguises, in random texts: each is found at its source characters."""
    rnd = random.Random(21)
    name = lambda: "".join(rnd.choice("bcdfghjklm") for _ in range(rnd.randint(2, 7)))
    brackets = ["[]", "()", "{}", "<>"]
    digits = [w for w, v in pii.NUMBER_WORDS.items() if len(v) == 1]

    def mark(words, plain):
        o, c = rnd.choice(brackets)
        gap = rnd.choice(["", " "])
        w = rnd.choice([*words.split("|"), plain])
        return rnd.choice([f"{gap}{o}{w}{c}{gap}", f" {rnd.choice(words.split('|'))} "])

    for _ in range(2_000):
        dot = lambda: mark(pii.DOT_WORDS, ".")
        kind = rnd.choice(["email", "ip", "phone"])
        if kind == "email":
            local = name() + rnd.choice(["", "." + name(), dot() + name()])
            hidden = local + mark(pii.AT_WORDS, "@") + name() + rnd.choice([dot() + name() + dot(), dot()]) + rnd.choice(["com", "de", "info"])
        elif kind == "ip":
            hidden = str(rnd.randrange(256)) + "".join((rnd.choice([dot(), "."]) if i else dot()) + str(rnd.randrange(256)) for i in range(3))
        else:
            hidden = rnd.choice(["+", "plus "]) + rnd.choice([" ", "-"]).join(rnd.choice(digits) for _ in range(rnd.randint(9, 15)))
        if rnd.random() < 0.3:
            hidden = "".join(next((k for k, v in pii.LOOKALIKES.items() if v == ch), ch) if rnd.random() < 0.3 and kind == "email" else ch for ch in hidden)
        before, after = f"zq ¡{name()}! ", f"; {name()} é"
        base, spans = pii.find(before + hidden + after)
        assert (kind, len(before), len(before + hidden)) in spans, hidden


def test_plain_text_gains_nothing():
    plain = ["look at the dot", "one two three", "meet at noon, at home", "café at 5.30", "a@b.co", "see us at example.com", "the point at issue. Four or five, six", "version 1.2 point 4", "un deux trois", "a.b@c.de and at c.de"]
    for text in plain:
        base, spans = pii.find(text)
        assert base == spans == base_spans(text)


def test_long_runs_take_linear_time():
    import time

    n = 1_000_000
    took = {}
    for name, text in {
        "digits": "1" * n + " .", "digit pairs": "1" * (n // 2) + "." + "1" * (n // 2) + ". +1", "dotted": "1." * (n // 2), "words": "a dot " * (n // 6), "ats": "a at " * (n // 5) + "[dot] x", "at signs": "a@" * (n // 2),
        "numbers": "one " * (n // 4), "plus": "+1(" * (n // 3), "name": "x" * n + "@", "dots at": "a.b dot " * (n // 8) + "at x",
    }.items():
        began = time.process_time()
        pii.find(text)
        took[name] = time.process_time() - began
    began = time.process_time()
    sum(i for i in range(10_000_000))
    unit = time.process_time() - began  # half a second on most machines
    assert max(took.values()) < 10 * unit, took


def test_pii_rows(docs, none):
    for r in pii.digest(docs).collect():
        assert r.n_added >= 0
    assert pii.digest(docs).count() == len(ROWS)
    assert pii.digest(none).count() == 0


def test_pii_on_the_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.digest(docs).collect():
        spans = base_spans(text[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r.spans.split(","))


# --- the pipeline --------------------------------------------------------------------------------


def test_pipeline_against_its_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    original = {r.doc_id: r.text for r in docs.collect()}
    got = corpus_pipeline.run(spark, DATA)
    rows = got.collect()
    assert got.columns == [*docs.columns, "slot", "shard"] and rows
    assert all(original[r.doc_id] == r.text for r in rows)
    assert not [r for r in rows if any(b and b in r.text for b in bench)]
    fps = {r.doc_id: slow_fingerprint(r.text) for r in rows}
    assert len(set(fps.values())) == len(fps)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_stages_on_awkward_rows(docs, none, spark):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, none):
            out = stage(spark, rows, DATA)
            assert out.columns == rows.columns
            assert out.count() <= 3 * len(ROWS)
