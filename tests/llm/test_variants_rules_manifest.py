"""Spelling variants, URL rules and the Merkle manifest against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from earshot.llm import merkle, spelling, url_filters

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def near(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_words(docs, least_length=5, least_count=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def brute_forms(words):
    forms, out = {}, {}
    for w, n in words.items():
        about = [x for x in words if near(w, x)]
        best = min(about, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = len(about)
    def root(w):
        return root(forms[w]) if forms[w] else w
    return {(w, forms[w], root(w), words[w], out[w], words.get(forms[w])) for w in words}


def variants(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_words_of_texts(spark):
    draw = random.Random(5)
    texts = [(i, " ".join(draw.choice(["Straße", "MÜNCHEN", "river", "River's", "×××××", "naïve", "a1b2river", "kürzer-lang"]) for _ in range(80)))
             for i in range(60)] + [(None, "river river river"), (7, None), (8, ""), (9, "river " * 20_000), (9, "river")]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in texts], "doc_id long, text string, word string, n long")
    got = {r["word"]: r["n"] for r in spelling.corpus_words(docs).collect()}
    assert got == brute_words(texts)
    assert any(w not in "straße mÜnchen river naïve kürzer ×××××" for w in got)  # slips occur
    assert spelling.corpus_words(docs.limit(0)).count() == 0


def test_variants_equal_all_pairs(spark):
    draw = random.Random(11)
    words = {}
    for _ in range(700):
        w = "".join(draw.choice("abé") for _ in range(draw.randint(1, 7)))
        words[w] = draw.choice([1, 2, 3, 4, 8, 16, 40, 90])
    for k in range(30):  # a chain of forms, each twice as frequent as the one before
        words["z" * 12 + "y" * k] = 1 << k
    table = spark.createDataFrame([(w, n, "clash") for w, n in words.items()], "word string, n long, gram string")
    assert variants(spelling.spelling_variants(table)) == brute_forms(words)


def test_variants_of_odd_rows(spark):
    rows = [(None, 5), ("hause", 2), ("hause", 2), ("house", 9), ("mouse", 9), ("alone", None), ("", 4), ("a", 1)]
    got = variants(spelling.spelling_variants(spark.createDataFrame(rows, "word string, n long")))
    assert got == {
        ("hause", "house", "house", 4, 1, 9), ("house", None, "house", 9, 2, None), ("mouse", None, "mouse", 9, 1, None),
        ("alone", None, "alone", 0, 0, None), ("", None, "", 4, 1, None), ("a", "", "", 1, 1, 4)}
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.b", "", "block"), ("b", "/x", "block"), ("b", "/x", "allow"), ("", "", "block")]


def brute_rule(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3:]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for rule_host, rule_path, verdict in rules:
        rule_host = rule_host.lower()
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            fits.append((len(rule_host + rule_path), len(rule_host), verdict == "block", rule_host + rule_path, verdict))
    best = max(fits, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://Sub.Example.NET/en/a?x=/de/", "https://example.net/en", "https://notexample.net/en/",
    "https://www.example.com/de/1#top", "https://example.com?/de/", "http://x.org/fr/", "http://x.org/fr", "http://a.b", "http://b/xy", "http://c.b:80/x",
    "http://a..net/q", "http://net./q", "x://y://z.net/", "http://ünï.net/é", "http://a b.net/ c", "http://" + "a." * 3000 + "net/" + "p" * 50_000, "http://.b/x\ny",
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_rules_equal_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_filters, "MOST_BROADCAST", 0)
    rows = [(k if k != 3 else None, u, "h") for k, u in enumerate(URLS + URLS[:5])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    for rules in (RULES, RULES[:-1] + RULES[:2], RULES[:4], []):
        table = spark.createDataFrame(rules, "host string, path string, verdict string")
        got = sorted(tuple(r) for r in url_filters.filter_urls(pages, table).select(
            F.coalesce("page_id", F.lit(-1)), F.coalesce("url", F.lit("")), "host", "path", F.coalesce("rule", F.lit("-")), "verdict").collect())
        want = sorted((-1 if k is None else k, u or "", h, p, "-" if r is None else r, v)
                      for k, u, _ in rows for h, p, r, v in [brute_rule(u, rules)])
        assert got == want
    assert url_filters.filter_urls(pages.limit(0), table).count() == 0


def test_rules_with_nulls_are_refused(spark):
    pages = spark.createDataFrame([(1, "http://a/")], "page_id long, url string")
    for rule in [(None, "/", "block"), ("a", None, "block"), ("a", "/", None), ("a." * 200, "/", "block"), ("a", "/" * 3000, "block")]:
        with pytest.raises(ValueError):
            url_filters.filter_urls(pages, spark.createDataFrame([rule], "host string, path string, verdict string"))


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute_manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars) to the sorted result."""
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row, more=0):
        doc_id, text, lang, source, n_chars = row
        return sha(*map(field, (doc_id, source, lang, n_chars + more if n_chars is not None else None, text)))

    trees = defaultdict(list)
    for row in rows:
        hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
        trees[row[2]].append(((row[0] is not None, row[0] or 0, leaf(row)), row[0], leaf(row), leaf(row, int(hit))))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {lang: levels([x[2] for x in sorted(trees[lang])]) for lang in langs}
    upper = levels([built[lang][-1][0] for lang in langs])
    out = []
    for t, lang in enumerate(langs):
        for k, (_, doc_id, own, folded) in enumerate(sorted(trees[lang])):
            siblings = []
            for nodes, at in ((built[lang], k), (upper, t)):
                for level in nodes[:-1]:
                    other = level[at ^ 1:(at ^ 1) + 1]
                    siblings += other
                    folded = sha(*(other + [folded] if at % 2 else [folded] + other))
                    at //= 2
            out.append((doc_id, own, built[lang][-1][0], upper[-1][0], sha(*siblings), folded, folded == upper[-1][0]))
    return sorted(out, key=repr)


def manifest(df):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shape", ["many", "one", "lone", "odd"])
def test_manifest_equals_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(merkle, "RUN_LEVELS", 2 if shape == "one" else 4)
    monkeypatch.setattr(merkle, "STRIDE", 1 if shape == "one" else 2)
    monkeypatch.setattr(merkle, "SHARES", 4)
    draw = random.Random(3)
    if shape == "many":
        rows = [(i, f"t{i}", draw.choice(["de", "en", "en", "en", "é", None, "zz"]), "s", i) for i in range(150)]
    elif shape == "one":
        rows = [(i, f"t{i}", "en", None, i) for i in range(33)]
    elif shape == "lone":
        rows = [(i, "x", f"l{i}", "s", None) for i in range(21)] + [(100 + i, "x", "pair", "s", 1) for i in range(2)]
    else:
        rows = [(None, None, None, None, None), (None, "", None, "", 5), (7, "a", "en", "s", (1 << 63) - 1), (7, "a", "en", "s", 1), (7, "a", "en", "s", 1),
                (-3, "long " * 100_000, "en", "ü", -1), (14, "b", "", "s", 0)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], DOCS + ", leaf string").repartition(5)
    assert manifest(merkle.merkle_manifest(merkle.leaves_of(docs))) == brute_manifest(rows)


def test_manifest_of_many_leaves_and_none(spark):
    docs = spark.range(2600).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"),
                                    F.when(F.col("id") % 100 > 0, "en").alias("lang"), F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    rows = [(i, f"t{i}", "en" if i % 100 else None, "s", i) for i in range(2600)]
    found = merkle.merkle_manifest(merkle.leaves_of(docs))
    assert manifest(found) == brute_manifest(rows)
    assert merkle.merkle_manifest(merkle.leaves_of(docs.limit(0))).count() == 0
