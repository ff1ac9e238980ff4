"""Operators that work text by text, against brute force and on edge cases."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from earshot.llm import html_main, language_id, packing, prefix_bpe, token_files
from earshot.llm.chunk_cache import ChunkEncoder, chunk_encoder

BYTE_BPE = P.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = P.path("word_bpe_49k.json")
EDGES = [
    (1, "One two, three.\nFour\tfive  six.", "en"), (2, None, "en"), (3, "", None), (4, " \t\n ", "de"),
    (5, "é中😀 x\x1cy\x85z　w  q", "fr"), (5, "same id, other text", "fr"), (1, "One two, three.\nFour\tfive  six.", "en"),
    (None, "no id", "en"), (8, "word " * 30_000, "en"), (9, "<|endoftext|> it's 12ab", None),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = spark.createDataFrame(EDGES, "doc_id long, text string, lang string")
    clash = ("score", "kept", "ids", "tokens", "shard", "pack_group", "h", "n_tokens", "lang_pred")
    return rows.withColumns({name: F.lit("clash") for name in clash}).repartition(3)


@pytest.fixture(scope="module")
def empty(edges):
    return edges.where("false")


@pytest.fixture(scope="module")
def reference():
    with open(BYTE_BPE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.TextEncoder(BYTE_BPE, P.PATTERN)


def _tokenizer():
    return Tokenizer.from_file(WORD_BPE)


def _ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_text_encoding_is_that_of_the_rank_merges(encoder, reference):
    draw = random.Random(1)
    for _ in range(4000):
        text = "".join(draw.choice("ab \n\t'sx1é中　\x1c\x85=-.😀ß") for _ in range(draw.randrange(14)))
        assert encoder.encode(text).tolist() == reference.encode_ordinary(text), repr(text)


def test_prefix_table_appends_and_edits(encoder, reference):
    draw = random.Random(2)
    for k in range(200):
        data = bytes(draw.randrange(256) if k % 2 else draw.choice(b"aabethion =") for _ in range(draw.randrange(1, 90)))
        table = prefix_bpe.PrefixEncoding(encoder.table, data)
        if data not in encoder.table.ranks:
            assert table.ids() == reference._encode_single_piece(data)
        table.append(b"the ation")
        full = data + b"the ation"
        assert table.last == prefix_bpe.PrefixEncoding(encoder.table, full).last
        at = draw.randrange(len(full))
        table.edit(at, min(at + 2, len(full)), b"xyz")
        assert table.last == prefix_bpe.PrefixEncoding(encoder.table, full[:at] + b"xyz" + full[at + 2:]).last


def test_edit_near_the_start_keeps_the_far_end(encoder):
    table = prefix_bpe.PrefixEncoding(encoder.table, b"the nation of " * 200)
    assert table.edit(5, 6, b"o") < 200


def test_encoding_digests(edges, empty, reference):
    path = (BYTE_BPE, P.PATTERN)
    rows = prefix_bpe.encoding_digests(prefix_bpe.encode_documents(edges, *path), *path).collect()
    want = []
    for doc_id, text, _ in EDGES:
        ids = reference.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert prefix_bpe.encoding_digests(prefix_bpe.encode_documents(empty, *path), *path).count() == 0


def test_chunks_encode_as_whole_texts():
    encoder, plain = ChunkEncoder(WORD_BPE), _tokenizer()
    draw = random.Random(3)
    for _ in range(1500):
        text = "".join(draw.choice("abTHE \n\t'sx1é中　\x1c\x85=-.😀ßΣİ́ſ%&") for _ in range(draw.randrange(20)))
        assert np.frombuffer(encoder.encode(text), encoder.width).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("dictionary", [True, False])
def test_token_files(spark, edges, tmp_path, dictionary):
    path = f"{tmp_path}/tokens"
    token_files.write_token_files(edges, path, WORD_BPE, dictionary=dictionary)
    files = token_files.read_token_files(spark, path)
    rows = token_files.with_ids_crc(files).orderBy("start").collect()
    plain = _tokenizer()
    want = {(d, len(i), _crc(i)) for d, t, _ in EDGES for i in (_ids(plain, t),)}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in rows} == want and len(rows) == len(EDGES)
    assert [r.doc_id for r in rows] == sorted((d for d, _, _ in EDGES), key=lambda d: (d is not None, d or 0))
    at = 0
    for row in rows:
        assert row.start == at
        at += row.n_tokens
    picked = files.where("doc_id = 9").select("tokens").first().tokens
    assert picked == _ids(plain, EDGES[-1][1])


def test_token_files_of_nothing(spark, empty, tmp_path):
    token_files.write_token_files(empty, f"{tmp_path}/none", WORD_BPE)
    assert token_files.with_ids_crc(token_files.read_token_files(spark, f"{tmp_path}/none")).count() == 0


@pytest.mark.parametrize("lengths", [[], [1], [4096], [5000, 1, 1, 9000, 4096], [7] * 3000, list(range(1, 400))])
def test_plan_fills_every_sequence(lengths):
    pieces = packing.plan_sequences(lengths)
    by_doc, by_sequence = {}, {}
    for doc, start, n, sequence, offset in pieces:
        by_doc.setdefault(doc, []).append((start, n))
        by_sequence.setdefault(sequence, []).append((offset, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(by_doc.get(doc, [])):
            assert start == at
            at += size
        assert at == n
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 4096 or at & (at - 1) == 0


def test_plan_balances_cost():
    draw = random.Random(4)
    lengths = [draw.randrange(20, 1500) for _ in range(2000)]
    costs = {}
    for _, _, n, sequence, _ in packing.plan_sequences(lengths):
        costs[sequence] = costs.get(sequence, 0) + n + n * n / 2048
    full = sorted(costs.values())[10:]
    assert full[-1] < 1.5 * full[len(full) // 2]


@pytest.mark.parametrize("group_chars", [1_000, 8_000_000])
def test_packing_holds_every_id_once(edges, empty, group_chars):
    pieces = packing.pack(edges, WORD_BPE, group_chars=group_chars).collect()
    plain = _tokenizer()
    want = sorted((str(d), i) for d, t, _ in EDGES for i in (_ids(plain, t),))
    ids = {}
    for p in pieces:
        assert p.length * 4 == len(p.ids) and p.length <= 4096
        ids.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    total = sum(len(i) for _, i in want)
    assert sum(p.length for p in pieces) == total
    joined = [i for key, parts in ids.items() if key[0] not in (1,) for i in [sum((x for _, x in sorted(parts)), [])]]
    assert sorted(joined) == sorted(i for d, i in want if d != "1")
    first = _ids(plain, EDGES[0][1])  # the row that occurs twice: every id of it twice
    placed = sorted((start + k, i) for start, part in ids[1, len(first)] for k, i in enumerate(part))
    assert placed == sorted([*enumerate(first), *enumerate(first)])
    assert packing.pack(empty, WORD_BPE).count() == 0


def _phrases(text, sample):
    count = 0
    for k in range(0, len(text), language_id.SEGMENT):
        part, at = text[k:k + language_id.SEGMENT], 0
        while at < len(part):
            end = at + 1
            while end <= len(part) and part[at:end] in sample:
                end += 1
            count, at = count + 1, max(end - 1, at + 1)
    return count


def test_phrases_against_string_search():
    draw = random.Random(5)
    samples = {"a": "".join(draw.choice("abc ") for _ in range(300)), "b": "".join(draw.choice("cde ") for _ in range(200))}
    samples = {k: " ".join(v.split()) for k, v in samples.items()}
    parser = language_id.CrossParser(samples)
    texts = [" ".join("".join(draw.choice("abcde  xy") for _ in range(n)).split()) for n in (0, 1, 5, 700, 1500)]
    counts, letters = parser.phrases(texts)
    assert counts.tolist() == [[_phrases(t, samples[k]) for k in parser.languages] for t in texts]
    assert letters.tolist() == [sum(c.isalpha() for c in t) for t in texts]


def test_language_edges(edges, empty):
    sample = {"en": "one two three four five six word no id same other text", "fr": "ce ne sont pas des mots"}
    rows = language_id.identify_languages(edges, sample).collect()
    found = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in rows}
    assert len(rows) == len(EDGES) and found[2, None] == found[3, ""] == found[4, " \t\n "] == ("und", 0.0)
    assert found[8, EDGES[8][1]][0] == "en" and all(0 <= s <= 1 for _, s in found.values())
    assert {r.lang_pred for r in language_id.identify_languages(edges, {}).collect()} == {"und"}
    assert language_id.identify_languages(empty, sample).count() == 0
    assert language_id.labelled_sample(empty) == {}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sample = language_id.labelled_sample(docs)
    assert set(sample) == {"de", "en", "es", "fr"}
    found = language_id.identify_languages(docs.where(language_id.held_out()), sample)
    right, n = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert right / n > 0.97


def test_held_out_never_learned(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    held = {f"text {i}" for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert not held & set(language_id.labelled_sample(docs, docs_per_language=400)["en"].split("\n"))


ARTICLE = "<article><h1>The title</h1><p>First   paragraph, with\n<b>bold</b> words.<p>Second one &amp; more.</p>To.</article>"
WANT = "The title\nFirst paragraph, with bold words.\nSecond one & more.\nTo."
PAGES = [
    (f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li><a>menu</a></ul></nav>"
     f"<div class='ad'>Buy, now.</div>{ARTICLE}<footer>&copy; me</footer></body></html>", WANT),
    (f"<body><header>Site name</header><aside>side, bar.</aside>{ARTICLE}<section id=comments><article class=comment><p>I say, no."
     "</article></section><form><label>mail</label><button>go</button></form>", WANT),
    ("<div id='main'><div class='content'><h2>Head</h2><p>A long paragraph, with commas, and words. It goes on, for a while.</p>"
     "<p>Short.</p></div><div class='sidebar'>links</div></div>", "Head\nA long paragraph, with commas, and words. It goes on, for a while.\nShort."),
    ("<article><h1>Only a title</h1><p><b>Bold only<br></article>", "Only a title\nBold only"),
    ("plain text, no tags", "plain text, no tags"), ("<<<p>broken <b>markup", None), ("", ""), (None, ""),
    ("<p>" * 3000 + "deep, text." + "</div>" * 10, "deep, text."),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>x&nbsp;y&#8364;</article>", "one\ntwo\na\nb\nx y€"),
    ("<article><p>a<!-- hidden <p> -->b<noscript>no</noscript></article>", "ab"),
    ("<div class='cookie-notice'>We use cookies, sorry.</div><article><p>Text, here.</p></article>", "Text, here."),
]


@pytest.mark.parametrize("page,want", [p for p in PAGES if p[0] is not None and p[1] is not None])
def test_main_text(page, want):
    assert html_main.main_text(page) == want


TEXT = "A long paragraph, with commas, and words. It goes on, for a while."
NAMED = [
    *((f"<body><div class='{c}'><article><p>{TEXT}</p></article></div></body>", TEXT)
      for c in ("content has-sidebar", "no-sidebar", "overflow-hidden", "menu-open", "sidebar", "search", "content notice")),
    *((f"<body class='{c}'><article class='{d}'><p>{TEXT}</p></article></body>", TEXT)
      for c, d in (("comments-open", "has-comments"), ("comments", "post"), ("single no-sidebar", "comment-count-2"))),
    *((f"<article><p>We saw <a {a}>the valley</a>, and left.</p></article>", "We saw the valley, and left.")
      for a in ('href="/hidden-gems"', 'title="the hidden valley"', 'data-hidden="false"', 'href="/p?id=search"', "href=/p?id=search",
                'title="a class=\'ad\' role=search"', "data-class='ad'", "aria-hidden='false'")),
    (f"<form id='aspnetForm'><div class='sidebar'>Links, more.</div><article><p>{TEXT}</p></article></form>", TEXT),
    (f"<div id='search'><p>{TEXT}</p><p>{TEXT}</p></div>", f"{TEXT}\n{TEXT}"),
    (f"<article><p>{TEXT}</p></article><div class='related'><article><p>Short, one.</p></article><article>Two.</article></div>", TEXT),
    (f"<div class='sidebar'><article><p>{TEXT}</p><span class='share'>Share, now.</span></article></div>", TEXT),
    (f"<article><p>{TEXT}</p><p class='x' HIDDEN>No, no.</p><p style='Display: none'>No.</p><p id = \"Side_Bar\">No.</p></article>", TEXT),
    (f"<article><p>{TEXT}</p></article><section id=comments><article class=comment><p>{TEXT} {TEXT}</article></section>", TEXT),
]


@pytest.mark.parametrize("page,want", NAMED)
def test_names_do_not_take_the_article(page, want):
    assert html_main.main_text(page) == want


LONG = " ".join(["The valley was quiet, and nobody, so they say, had seen it."] * 8)
MENU = "<ul><li><a>Home</a></li><li><a>World news</a></li><li><a>Sport</a></li></ul>"
TEASER = "<div>Read what else happened in town today.</div>"
UNNAMED = [
    (f"<body>{TEASER}{MENU}<div><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div>{TEASER}{MENU}</body>", f"Title\n{LONG}\n{LONG}"),
    (f"<body>{TEASER}<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p>Bye.</article>{MENU}</body>", f"Title\n{LONG}\n{LONG}\nBye."),
    (f"<body><main>{MENU}<h1>Title</h1><p>{LONG}</p><ul><li>one</ul><p>{LONG}</p>{TEASER}</main></body>", f"Title\n{LONG}\none\n{LONG}"),
    (f"<body>{MENU * 30}<div><p>{LONG}</p><h2>Next</h2><p>{LONG}</p></div>{MENU * 30}</body>", f"{LONG}\nNext\n{LONG}"),
    (f"<div><section><p>{LONG}</p></section><section><p>{LONG}</p></section></div><div>Ok</div>", f"{LONG}\n{LONG}"),
]


@pytest.mark.parametrize("page,want", UNNAMED)
def test_paths_tell_the_article_without_names(page, want):
    assert html_main.main_text(page) == want


def test_pages(spark):
    rows = spark.createDataFrame([(i, "u", page) for i, (page, _) in enumerate(PAGES)] * 2, "page_id long, url string, html string")
    got = html_main.extract_main_text(rows.withColumn("text", F.lit("clash"))).collect()
    assert len(got) == 2 * len(PAGES) and all(r.text is not None for r in got)
    assert html_main.extract_main_text(rows.where("false")).count() == 0


def test_article_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in html_main.extract_main_text(pages).collect():
        page = pages.where(F.col("page_id") == row.page_id).first().html
        inner = page[page.index("<article>"):page.index("</article>")]
        words = "".join(inner.replace("<", " <").split())
        assert row.text and all("".join(line.split())[:20] in __import__("html").unescape(words) for line in row.text.split("\n"))


def test_strings_of_added_tokens_are_read_as_the_library_reads_them():
    encoder, plain = chunk_encoder(WORD_BPE), _tokenizer()
    for text in ("end <|endoftext|> of", "<|ENDOFTEXT|> x", "<|startoftext|><|endoftext|>", "a <|endoftext |> b", "no such string"):
        ids = np.frombuffer(encoder.encode(text), encoder.width).tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids


PARAGRAPH = "<p>" + "The river rose, and the town, as ever, waited; nobody left. " * 7 + "</p>"


@pytest.mark.parametrize("page, lines", [
    (f"<body><h1>Head</h1>{PARAGRAPH}{PARAGRAPH}<ul><li>last point one<li>last point two</ul></body>", ["last point one", "last point two"]),
    (f"<body><h1>Head</h1>{PARAGRAPH}{PARAGRAPH}<blockquote>He said so.</blockquote></body>", ["He said so."]),
    (f"<body><h1>Head</h1><div>Opening line.</div>{PARAGRAPH}{PARAGRAPH}</body>", ["Opening line."]),
])
def test_short_parts_of_an_article_stay(page, lines):
    found = html_main.main_text(page).split("\n")
    assert set(lines) <= set(found) and "Head" in found
