"""Operators that compare documents, and the pipeline, against brute force and on edge cases."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm import exact_dedup, line_dedup, minhash, quality, quotes

SPACE = re.compile(r"[\x20\x09-\x0D]+")
CLASH = ("kept", "u", "v", "a", "b", "node", "key", "label", "first", "gone", "id", "h", "x", "y", "at", "target", "bucket", "component_id", "_any")
SF = "/root/testdata/sf0.001"


def _frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({name: F.lit("clash") for name in CLASH}).repartition(parts)


# --- exact dedup -------------------------------------------------------------------------------------------------

def test_trie_with_and_without_spill():
    draw = random.Random(1)
    for limit in (8, 50, 1 << 20):
        trie, want = exact_dedup.PatriciaTrie(lambda a, b: a + b, limit), {}
        for _ in range(2000):
            key = bytes(draw.choice(b"ab") for _ in range(draw.randrange(10)))
            trie.insert(key, 1)
            want[key] = want.get(key, 0) + 1
        assert dict(trie.items()) == want


def _brute_exact(rows):
    groups = {}
    for k, (doc_id, text) in enumerate(rows):
        groups.setdefault(SPACE.sub("", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, k))
    out = []
    for plain, members in groups.items():
        best = min(members, key=lambda m: m[:3])
        keep = None if best[1] else best[2]
        digest = hashlib.sha256(plain.encode()).hexdigest()
        out += [(None if m[1] else m[2], keep, len(members), digest) for m in members]
    return sorted(map(str, out)), len(groups)


@pytest.mark.parametrize("limit", [40, exact_dedup.TRIE_BYTES])
def test_exact_dedup_edges(spark, limit):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice(["a", "b", "é"]) for _ in range(draw.randrange(5)))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, " \t\x0b"), (7, "a b"), (7, "a b"), (None, "ab"), (None, None), (503, "x" * 200_000), (504, "x " * 200_000)]
    found = exact_dedup.exact_duplicates(_frame(spark, rows, 5), limit).collect()
    want, groups = _brute_exact(rows)
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in found) == want
    assert sum(r.kept for r in found) == groups
    assert all(not r.kept or r.doc_id == r.keep_id for r in found)
    assert exact_dedup.exact_duplicates(_frame(spark, rows).where("false")).count() == 0


# --- near-duplicates ---------------------------------------------------------------------------------------------

def _shingles(text, size):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in SPACE.split(words) if w]
    if not words:
        return frozenset()
    n = min(size, len(words))
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1))


def _brute_near(rows, size, percent=80):
    sets, parent = {}, {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets.setdefault(doc_id, []).append(_shingles(text, size))
            parent[doc_id] = doc_id

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        lo, hi = sorted((root(a), root(b)))
                        parent[hi] = lo
    return sorted(map(str, [
        (d, len(_shingles(t, size)), None if d is None else root(d), d is None or root(d) == d) for d, t in rows]))


def _near_rows():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, number = [], 0
    for _ in range(6):  # groups of copies changed here and there, chains among them
        base = [draw.choice(vocabulary) for _ in range(draw.randrange(40, 120))]
        for _ in range(12):
            words = list(base)
            for _ in range(draw.randrange(0, 9)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                base = words
            rows.append((number, " ".join(words)))
            number += 1
    rows += [(number + k, " ".join(draw.choice(vocabulary) for _ in range(30))) for k in range(40)]
    rows += [(900, None), (901, ""), (902, " \n "), (903, "One"), (904, "one"), (905, "ONE two"), (906, "one  two"), (907, rows[0][1]), (907, rows[0][1]),
             (None, rows[0][1]), (None, None), (908, "long " * 30_000), (909, "long " * 30_001)]
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_all_pairs(spark, size):
    rows = _near_rows()
    found = minhash.near_duplicates(_frame(spark, rows), size=size).collect()
    assert sorted(str(tuple(r)) for r in found) == _brute_near(rows, size)


def test_open_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rows = _near_rows()
    found = minhash.near_duplicates(_frame(spark, rows), size=2).collect()
    assert sorted(str(tuple(r)) for r in found) == _brute_near(rows, 2)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(_frame(spark, [(1, "a")]).where("false"), size=2).count() == 0


def test_counts_never_rule_out_a_common_shingle():
    draw = np.random.default_rng(7)
    sets = [np.unique(draw.integers(0, 1 << 63, k, dtype=np.uint64) % np.uint64(m)) for k, m in ((5, 50), (300, 900), (300, 900), (90_000, 1 << 40), (90_000, 1 << 40))]
    for x in sets:
        for y in sets:
            own, other = (np.frombuffer(minhash.cell_counts(s), np.uint8) for s in (x, y))
            most = minhash._most_common(other[None], own, np.array([len(y)]), len(x))[0]
            assert len(np.intersect1d(x, y)) <= most <= min(len(x), len(y))


def test_components(spark):
    draw = random.Random(4)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    linked = {x for a, b in links if a != b for x in (a, b)}
    found = {r.node: r.component for r in minhash.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: root(x) for x in linked}


# --- quality -----------------------------------------------------------------------------------------------------

def _brute_rules(text):
    words = [w for w in SPACE.split(text or "") if w]
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    counts = {w: windows.count(w) for w in set(windows)}
    covered = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if SPACE.sub("", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_counts(spark):
    draw = random.Random(5)
    rows = [(i, "".join(draw.choice(["a ", "b ", "c\n", "é\t", "#x ", "\n", "  "]) for _ in range(draw.randrange(160)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "a b c a b c a b"), (203, "a a a a"), (203, "a a a a"), (None, "x " * 60), (204, "w%d " % 1 * 20_000)]
    weights = [0.0] * 64
    found = quality.quality_rules(_frame(spark, rows), weights).collect()
    got = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in found)
    assert got == sorted(str((d, *_brute_rules(t))) for d, t in rows)
    assert all(r.kept != r.base_failed for r in found)  # weights of nothing: the ratio decides nothing
    assert quality.quality_rules(_frame(spark, rows).where("false"), weights).count() == 0
    assert quality.ratio_weights(_frame(spark, rows).where("false"), spark.createDataFrame([], "doc_id long"), 16) == [0.0] * 16


def test_ratio_against_counts(spark):
    rows = [(1, "a b a"), (2, "b c"), (3, None), (4, "x"), (None, "a")]
    trusted = spark.createDataFrame([(1,), (1,), (None,), (3,)], "doc_id long")
    docs = _frame(spark, rows)
    buckets = 32
    words = ["a", "b", "c", "x"]
    codes = {w: spark.range(1).select(F.xxhash64(F.lit(w)).alias("c")).first().c for w in words}
    pair = {}
    for left in words:
        for right in [*words, None]:
            second = F.lit(codes[right]) if right else F.lit(None).cast("long")
            pair[left, right] = spark.range(1).select(F.xxhash64(F.lit(codes[left]), second).alias("c")).first().c

    def grams(text):
        w = (text or "").split()
        return [codes[x] % buckets for x in w] + [pair[x, y] % buckets for x, y in zip(w, [*w[1:], None])]

    raw, target = [0] * buckets, [0] * buckets
    for doc_id, text in rows:
        for g in grams(text):
            raw[g] += 1
            target[g] += doc_id in (1, 3)
    share = sum(target) / sum(raw)
    want = [math.log((t + quality.PRIOR) / (r * share + quality.PRIOR)) for r, t in zip(raw, target)]
    got = quality.ratio_weights(docs, trusted, buckets)
    assert got == pytest.approx(want)
    for row in quality.quality_rules(docs, got).collect():
        text = dict(rows)[row.doc_id]
        assert row.ratio == pytest.approx(sum(want[g] for g in grams(text)) / max(1, len(grams(text))))


def test_quality_tells_junk_from_clean(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rated = quality.quality_rules(docs, quality.ratio_weights(docs, labels.where("quality = 1"))).where("NOT base_failed").join(labels, "doc_id")
    kept = {r.quality: r.share for r in rated.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.5


# --- line dedup --------------------------------------------------------------------------------------------------

def _brute_lines(rows):
    """Rows must differ in (doc_id, text); ties of doc_id are ordered by the row's hash, so the tests have none."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = (text or "").split("\n")
        full = [(i, line.strip(" \t\r\x0b\x0c")) for i, line in enumerate(lines) if SPACE.sub("", line)]
        gone = set()
        for k in range(len(full) - 2):
            window = tuple(line for _, line in full[k:k + 3])
            if window in seen:
                gone.update(i for i, _ in full[k:k + 3])
            seen.add(window)
        out.append((doc_id, "\n".join(line for i, line in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return sorted(map(str, out))


def test_line_dedup_against_brute_force(spark):
    draw = random.Random(6)
    rows = [(i, "\n".join(draw.choice(["p", "q ", " r", "", "s", "é"]) for _ in range(draw.randrange(12)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "p\nq\nr\ns\np"), (103, "a\na\na\na\na\na"), (104, "line\n" * 20_000)]
    found = line_dedup.line_dedup(_frame(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in found) == _brute_lines(rows)
    assert line_dedup.line_dedup(_frame(spark, rows).where("false")).count() == 0


def test_line_dedup_of_repeated_rows(spark):
    found = line_dedup.line_dedup(_frame(spark, [(1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (2, "x\na\nb\nc")])).collect()
    assert sorted((r.doc_id, r.text, r.n_removed) for r in found) == [(1, "a\nb\nc\nd", 0), (1, "a\nb\nc\nd", 0), (2, "x", 3)]


# --- quotes ------------------------------------------------------------------------------------------------------

def test_quotes(spark):
    rows = [
        (1, 0, "user", "How do I sort\na list?\nIn place, please."), (1, 1, "assistant", "Which language?"),
        (1, 2, "user", "Ann wrote:\n> which   LANGUAGE?\nPython."),
        (1, 3, "assistant", "> > Which language?\n> Python.\nUse sort.\n> In place, please.\nDone."),
        (1, 4, "user", "> nobody said this\nok"), (2, 0, "user", "> Which language?\nother thread"), (2, 1, None, None),
        (None, 0, "user", "> Python."), (1, None, "user", "> Python."), (1, 5, "user", ">"), (1, 5, "user", ">"), (3, 0, "user", "a > b"),
        (4, 0, "user", "later"), (4, 1, "user", ">later\n>>deeper " + "x " * 50_000),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("clash") for c in ("own", "passages", "h", "p", "k", "c", "t", "level", "rank", "place", "reply_to")})
    found = quotes.link_quotes(messages).collect()
    by = {(r.conv_id, r.turn): r for r in found}
    assert len(found) == len(rows)
    assert by[1, 2].reply_to == 1 and by[1, 2].text == "Python." and by[1, 2].n_quotes == 1
    assert by[1, 3].reply_to == 2 and by[1, 3].max_level == 2 and by[1, 3].n_quotes == 3 and by[1, 3].text == "Use sort.\nDone."
    assert by[1, 4].reply_to is None and by[1, 4].text == "ok" and by[2, 0].reply_to is None
    assert by[2, 1].text == "" and by[2, 1].chat == "<||>\n\n<|end|>" and by[None, 0].reply_to is None
    assert by[3, 0].text == "a > b" and by[3, 0].n_quotes == 0 and by[4, 1].reply_to == 0
    order = [(r.place, r.turn) for r in found if r.conv_id == 1 and r.turn is not None]
    assert order == sorted(order)
    assert quotes.link_quotes(messages.where("false")).count() == 0


# --- pipeline ----------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [(10_000, None, "en"), (10_001, "", "en"), (10_002, "12 34 !!", None), (None, "no id here", None)], "doc_id long, text string, lang string")
    once = base.where("doc_id = 0").select("doc_id", "text", "lang")
    docs = base.unionByName(extra, allowMissingColumns=True).unionByName(once, allowMissingColumns=True)
    docs = docs.withColumns({"score": F.lit("clash"), "kept": F.lit(1), "_rows": F.lit(2), "n_words": F.lit(3)})
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, before, SF), name)
        assert after.columns == docs.columns, name
        assert after.exceptAll(before).count() == 0, name
        before = after
    ids = {r.doc_id for r in before.collect()}
    assert not ids & {10_000, 10_001, 10_002}
    assert before.where("doc_id = 0").count() == 1
    pieces = corpus_pipeline.pack_sequences(spark, before, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ids


def test_pipeline_keeps_clean_documents(spark):
    """What goes is unknown language, junk, or a copy whose group keeps one."""
    base = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    told = corpus_pipeline.drop_unknown_languages(spark, base, SF)
    assert told.count() == base.count()
    good = corpus_pipeline.drop_low_quality(spark, told, SF)
    gone = told.join(good, "doc_id", "left_anti").join(labels.where("quality = 1"), "doc_id")
    assert all(_brute_rules(r.text)[-1] for r in gone.collect())


def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        assert after.count() == 0
        docs = after if "text" in after.columns else docs


def test_copies_are_dropped_row_by_row(spark):
    rows = [(1, "a b"), (2, "ab"), (2, "other"), (None, "other"), (None, "ot her"), (None, "alone"), (3, "x"), (3, "x"), (3, "y"),
            (4, None), (5, " \t\x0b\x0c\r\n"), (None, "")]
    kept = corpus_pipeline.drop_copies(spark, _frame(spark, rows), SF)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, "a b"), (None, "ot her"), (None, "alone"), (3, "x"), (3, "y"), (5, " \t\x0b\x0c\r\n")], key=str)
