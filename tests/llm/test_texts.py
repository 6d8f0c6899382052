"""Encoding, page text, personal data and quality, without Spark where none is needed."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest

from fitlens.llm import bpe, html_text, pii, quality

DOCS = "doc_id long, text string, extra string"


# --- byte-level BPE


@pytest.fixture(scope="module")
def encoder():
    import public_tokenizers
    import tiktoken

    vocab = bpe.vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return vocab, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def test_bpe_equals_tiktoken(encoder):
    vocab, own = encoder
    rng = random.Random(1)
    signs = ["'", "'s", "'ll", "'re", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", "a", "B", "é", "1", "²", "!", " ", "　", "漢", "🙂", "ᲊ", "\U00010d40", "''"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["", " ", "x" * 5000, "ab" * 40, "x" * 33, " " * 500, "<|endoftext|>", "abc" * 1000]
    for text, (ids, numbers) in zip(texts, bpe.encode_texts(texts, vocab)):
        assert ids == ",".join(map(str, own.encode_ordinary(text)))
        assert vocab.decode(numbers) == text.encode()


def test_bpe_scans_are_the_same_in_small_pieces(encoder, monkeypatch):
    vocab, _ = encoder
    texts = ["It's a test, isn't it?\n\n  Yes ", "", "a\n", " b", "'s"] * 20
    whole = [ids for ids, _ in bpe.encode_texts(texts, vocab)]
    monkeypatch.setattr(bpe, "SCAN", 3)
    monkeypatch.setattr(bpe, "CACHE", 2)
    assert [ids for ids, _ in bpe.encode_texts(texts, vocab)] == whole


def test_bpe_query_on_odd_rows(frame, encoder):
    import public_tokenizers

    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (None, "a", None), (2, None, None), (3, "", None), (4, "z" * 100_000, None)]
    out = bpe.bpe_round_trip(frame(rows, DOCS), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.decoded_sha256) for r in out) == sorted((i is None, i or 0, sha(t or "")) for i, t, _ in rows)
    assert all(len(r.ids) == r.n_tokens for r in out)
    assert bpe.bpe_round_trip(frame([], DOCS), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).count() == 0


# --- pages

PROSE = "The house on the hill was sold to a family that had come from the coast in the spring of that year."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        (None, ""),
        ("plain <", ""),
        (f"<html><body><nav><a href=/>Home</a></nav><article><h1>A title</h1><p>{PROSE}<p>Short.</article><footer>(c) {PROSE}</footer>", f"A title\n{PROSE}\nShort."),
        (f"<body><div class='ad'>{PROSE}</div><article><p>{PROSE}</p><div class=comments><p>{PROSE}</p></div></article>", PROSE),
        (f"<head><title>T</title><style>p{{}}</style></head><body><main><p>A &amp; B &lt; C&#33; &eacute;\n  x</p><script>'<p>no</p>'</script><p>{PROSE}</p></main>", f"A & B < C! é x\n{PROSE}"),
        (f"<article><p>one <b>two</b><br>three<!-- <p>no</p> --> {PROSE}</p><form><p>{PROSE}</p></form></article>", f"one two three {PROSE}"),
        (f"<div><p>{PROSE}</p><p>Yes.</p><p>{PROSE}</p></div><div id=sidebar><p>{PROSE}</p></div>", f"{PROSE}\nYes.\n{PROSE}"),
        (f"<body><nav><ul><li>x<article><p>{PROSE}</p></article>", PROSE),
        (f'<article><p title="a > b">{PROSE}</p><aside>{PROSE}</aside><p hidden>{PROSE}</p></article>', PROSE),
        ("<div><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>", ""),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_links_within_the_article_are_no_text():
    links = "".join(f"<li><a href=/{i}>Another story of the town {i}</a></li>" for i in range(5))
    also = "<p>Read also: <a href=/x>What the coast had to say about the family on the hill</a></p>"
    page = f"<article><h1><a href=/>A title</a></h1><ul>{links}</ul><p>{PROSE}</p>{also}<p>{PROSE}</p><h2>Part two</h2><p>{PROSE}</p><h3>Related</h3><ul>{links}</ul></article>"
    assert html_text.main_text(page) == f"A title\n{PROSE}\n{PROSE}\nPart two\n{PROSE}"
    # What is short and not linked follows its neighbours, within the article too.
    assert html_text.main_text(f"<main><p>{PROSE}</p><p>Yes.</p><ul>{links}<li>More</li>{links}</ul></main>") == f"{PROSE}\nYes."
    # A table has no stop words.
    assert html_text.main_text(f"<article><p>{PROSE}</p><p>Wheat 12 | Barley 14 | Oats 9 | Rye 31 | Maize 5 | Rice 8</p></article>").endswith("Rice 8")


def test_broken_markup_takes_linear_time():
    start = time.time()
    for piece in ("<a ", '<a "', "<div><a '", "<", "<p", "</div>", "<div>", "<!-", '<a b="', "&", "<nav></p>"):
        html_text.main_text(piece * 10_000)
    assert time.time() - start < 60


def test_open_blocks_follow_their_nearest_neighbours():
    block = lambda main=False: html_text.Block("x", 0, False, main)
    good, bad, undecided = html_text.GOOD, html_text.BAD, html_text.OPEN
    labels = html_text.last_labels([block()] * 7, [good, undecided, undecided, undecided, bad, undecided, bad])
    assert labels == [good, good, bad, bad, bad, bad, bad]
    assert html_text.last_labels([block(True)] * 2, [undecided] * 2) == [good, good]
    assert html_text.last_labels([], []) == []


def test_pages_query_on_odd_rows(frame):
    rows = [(1, "u", f"<p>{PROSE}</p>", 5), (1, "u", f"<p>{PROSE}</p>", 5), (None, None, None, None), (2, "v", "<" * 50_000, 1)]
    out = html_text.extract_pages(frame(rows, "page_id long, url string, html string, n_chars int")).collect()
    assert sorted((r.text, r.n_chars) for r in out) == [("", 0), ("", 0), (PROSE, len(PROSE)), (PROSE, len(PROSE))]


# --- personal data

BASE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    out = []
    for k, pattern in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                k == 0
                or (k == 1 and all(int(p) <= 255 for p in m.group().split(".")))
                or (k == 2 and 12 <= len(digits) <= 19 and pii.luhn(digits))
                or (k == 3 and 9 <= len(digits) <= 15)
            ):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB9@..-+ %()1234567890 \n_é") for _ in range(rng.randrange(60))) for _ in range(8000)]
    texts += ["4111 1111 1111 1111", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "+1 (269) 555-3296 4524132264652876", "x" * 9000 + "@", "9" * 9000]
    for text in texts:
        assert pii.base_spans(text) == plain_spans(text)


def test_viterbi_equals_all_paths():
    field = pii.train()
    tagger = pii.Tagger(field)
    for line in (["call", "(415)", "555-0132"], ["dot", "a1", "at"], ["0171", "2345678", "x", "+1"]):
        rows = [tagger.field.rows(w) for w in line]
        emit = [rows[i][1] + (rows[i - 1][0] if i else 0) + (rows[i + 1][2] if i + 1 < len(line) else 0) for i in range(len(line))]
        score = lambda path: sum(emit[i][y] + field.moves[path[i - 1] + 1 if i else 0][y] for i, y in enumerate(path))  # noqa: E731, B023
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(line)), key=score)
        assert tuple(tagger.labels([line])[0]) == best


def test_field_learns_its_table_and_adds_spans():
    tagger = pii.Tagger(pii.train())
    for sentence in pii.SENTENCES:
        words, labels = pii.parsed(sentence)
        assert tagger.labels([words])[0].tolist() == labels
    text = "Please phone (646) 555-0101, today.\nOr mail a@b.org\nthe house on the hill"
    (base, spans), (none, nothing) = pii.find_all([text, ""], tagger)
    assert pii.spans_text(spans) == "phone:13:27,email:44:51"
    assert base == [(44, 0, 51)] and none == nothing == []


def test_personal_data_query_on_odd_rows(frame):
    rows = [(1, "a@b.org and 10.0.0.1", "x"), (1, "a@b.org and 10.0.0.1", "x"), (None, None, None), (2, "", None), (3, "word " * 30_000, None)]
    out = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans) for r in pii.find_personal_data(frame(rows, DOCS)).collect()}
    assert out == {(1, 1, 1, 0, 0, "email:0:7,ip:12:20"), (None, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, ""), (3, 0, 0, 0, 0, "")}
    assert pii.find_personal_data(frame([], DOCS)).count() == 0


# --- quality


def test_trees_separate_and_flat_arrays_equal_a_walk():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    trees = quality.grow(x, y)
    scores = trees.scores(x)
    assert ((scores > 0.5) == y).mean() > 0.98

    def walk(row):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] >= 0:
                node = trees.left[node] + (row[trees.feature[node]] > trees.threshold[node])
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(scores[:50], [walk(r) for r in x[:50]])


@pytest.mark.parametrize("labels", [[], [1, 1, 1], [0, 0]])
def test_trees_without_two_labels(labels):
    x = np.zeros((len(labels), len(quality.FEATURES)))
    scores = quality.grow(x, np.array(labels, float)).scores(np.zeros((2, len(quality.FEATURES))))
    assert scores[0] == scores[1] and (not labels or (scores[0] > 0.5) == (labels[0] == 1))


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    trees = quality.fit(docs, labels)
    rows = quality.score_documents(docs, trees).join(labels, "doc_id").filter("held_out").select("predicted", "quality").collect()
    assert len(rows) > 40 and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_quality_of_odd_rows(frame, spark):
    sf = "/root/testdata/sf0.001"
    trees = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    odd = frame([(1, None, 0.5), (2, "", 0.5), (None, "a b c", None), (1, None, 0.5), (3, "a " * 40_000, 1.0)], "doc_id long, text string, score double")
    out = quality.score_documents(odd, trees).collect()
    assert len({r.score for r in out if r.doc_id in (1, 2)}) == 1 and all(0 <= r.score <= 1 for r in out) and len(out) == 5
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    assert quality.accepted(odd, trees).columns == odd.columns


def test_quality_draws_one_text_of_an_id(frame, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "grow", lambda x, y: seen.append((x.tolist(), y.tolist())))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    docs = [(i, f"a text of number {i}") for i in ids] + [(ids[0], f"another {n}") for n in range(200)] + [(ids[1], None)]
    labels = [(i, i % 2) for i in ids] + [(ids[2], ids[2] % 2)] * 50
    for seed in (1, 2):
        random.Random(seed).shuffle(docs)
        quality.fit(frame(docs, "doc_id long, text string").repartition(3), frame(labels, "doc_id long, quality int"))
    assert [len(y) for _, y in seen] == [len(ids)] * 2 and seen[0] == seen[1]


# --- time of pages


@pytest.mark.parametrize("piece", ["<nav>x<article></article>", "<nav>x<article>y</article>", "<div><p>x", "</div><article>"])
def test_time_of_a_page_grows_with_its_elements(piece):
    def seconds(n):
        start = time.process_time()
        html_text.blocks_of(piece * n)
        return time.process_time() - start

    seconds(100)
    assert seconds(64_000) < 32 * seconds(4000) + 0.5
