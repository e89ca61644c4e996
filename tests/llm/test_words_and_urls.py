"""Collocations, spelling variants and URL filters: brute force, edges, held-out accuracy."""

from __future__ import annotations

import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from lendscape.llm import collocations, spelling, url_filters

SCHEMA = "doc_id long, text string, lang string, page_id long, url string, host string, `_features` int, word string, phrase string, n int"
ROWS = [
    (1, "some words, some words", "en", 1, "http://A.com/x", "h", 1, "w", "p", 1),
    (1, "some words, some words", "en", 1, "http://A.com/x", "h", 1, "w", "p", 1),
    (None, None, None, None, None, None, None, None, None, None),
    (2, "", None, 2, "", "", 0, "", "", 0),
    (3, " ".join(f"lengthy{chr(97 + i % 26)}" for i in range(40_000)), "de", 3, "http://" + "long." * 20_000 + "net/es/", "", 0, "", "", 0),
]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_collocations(rows, least=30, report=2000):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, 5):
                f[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) >= 2 and a >= least}
        gone = {p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 80 * c[p[i : i + k]]}
        best = []
        for p, a in found.items():
            if p not in gone:
                score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(best)[:report], 1)]
    return sorted(out)


def crowded(seed, n=260):
    rng = random.Random(seed)
    parts = ["a ", "B ", "c\t", "d ", "of the ", "x y z w ", ". ", "\n", " é ", "\x0b"]
    rows = []
    for _ in range(n):
        own = [rng.choice(parts + [f"r{rng.randrange(60)} "] * 3) for _ in range(rng.randrange(0, 120))]
        rows.append((rng.choice(["en", "en", "de", None]), "".join(own)))
    return [*rows, ("en", None), ("en", ""), (None, "a"), ("fr", "...")]


@pytest.mark.parametrize("shards, chunk, prime", [(1, 100, 97), (3, 300, 2**31 - 1), (4, 10**6, 199)])
def test_collocations_against_brute_force(spark, monkeypatch, shards, chunk, prime):
    monkeypatch.setattr(collocations, "PRIME", prime)  # few hashes let many others pass the bitmaps
    monkeypatch.setattr(collocations, "PAIR_COUNTERS", 1 << 12)
    rows = crowded(shards)
    found = collocations.frequent_phrases(spark.createDataFrame(rows, "lang string, text string").repartition(5), shards=shards, chunk=chunk)
    got = sorted(map(tuple, collocations.collocations(found).collect()))
    assert got == brute_collocations(rows) and len(got) > 50


def test_collocations_report_and_ties(spark):
    rows = [("en", "p q. r s. t u. v w x. ") for _ in range(40)]
    found = collocations.frequent_phrases(spark.createDataFrame(rows, "lang string, text string"))
    got = [tuple(r) for r in collocations.collocations(found, report=3).orderBy("rank").collect()]
    assert got == [r for r in brute_collocations(rows, report=3)]
    assert [r[2] for r in got] == ["p q", "r s", "t u"]  # `v w` and `w x` lie in `v w x`


def test_collocations_hash_distinct_words_as_arrays():
    """Encoding many distinct words calls no function for each of them."""
    text = b" . ".join(b"w%x  w%x" % (i, i * 7919 % 30_000) for i in range(30_000))
    plain = [w.encode() for w in dict.fromkeys(text.decode().split())]
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        words, hashes, is_word, ids = collocations.encode(text, 5)
    finally:
        sys.setprofile(None)
    assert len(calls) < len(plain)
    assert words.cast("large_binary").to_pylist() == plain and [plain[i] for i in ids[:5]] == text.split()[:5]
    assert is_word.sum() == len(plain) - 1 and 0 <= hashes.min() and hashes.max() < collocations.PRIME
    assert len(np.unique(hashes)) > 0.999 * len(plain)
    assert (collocations.encode(text, 6)[1] != hashes).mean() > 0.999
    long = [b"a" * 3000, b"a" * 2999, b"b" + b"a" * 2999]
    assert len(set(collocations.hash_words(pa.array(long).cast("large_string"), 5))) == 3
    assert [len(x) for x in collocations.encode(b"  ", 5)] == [0, 0, 0, 0]


def test_collocations_edges(odd, empty):
    assert collocations.collocations(collocations.frequent_phrases(empty)).count() == 0
    found = {(r["lang"], r["phrase"]): r["f"] for r in collocations.frequent_phrases(odd, chunk=1000).collect()}
    assert found["de", ""] == 40_000 and found["en", ""] == 8 and found["de", "lengthya lengthyb lengthyc lengthyd"] == 1539


def test_long_texts_are_cut_between_pieces():
    text = b" a b . c d . e f g h i"
    parts = list(collocations.chunks(text, 4))
    assert b"".join(parts) == text and all(p.endswith(b".") for p in parts[:-1]) and len(parts) == 3


def brute_variants(words, factor=spelling.FORM_FACTOR):
    letters = sorted(set("".join(words)))
    near, form = {}, {}
    for w in words:
        other = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i + k :] for i in range(len(w) + 1) for c in letters for k in (0, 1)}
        near[w] = [x for x in other if x in words and x != w]
        best = min(((-words[x], x) for x in near[w]), default=(0, None))
        form[w] = best[1] if best[1] and -best[0] >= factor * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


@pytest.mark.parametrize("limit, block", [(20_000, 50_000), (3, 5), (3, 10**6)])
def test_variants_against_brute_force(spark, limit, block):
    rng, words = random.Random(limit + block), {}
    for _ in range(300):  # crowded: parts that many words share are dealt again
        words["".join(rng.choice("abé") for _ in range(rng.randrange(6, 9)))] = rng.choice([5, 6, 30, 200, 1000, 9000])
    for _ in range(150):
        word = "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(6, 14)))
        words[word] = rng.choice([5, 6, 30, 200])
        words[word[:3] + word[4:] if len(word) > 6 else word + "k"] = rng.choice([5, 31, 200])
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = {r["word"]: tuple(r)[1:] for r in spelling.group_variants(df, limit=limit, block=block).collect()}
    assert got == brute_variants(words) and any(r[1] != r[0] and r[0] for r in got.values())


def test_index_finds_what_has_one_error():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 8))) for _ in range(200)})
    index = spelling.FmIndex(words)
    order = spelling.suffix_ranks(np.array([1, 2, 1, 2, 1, 0], np.int64), 2).tolist()
    assert order == sorted(range(6), key=lambda i: [1, 2, 1, 2, 1, 0][i:])
    want = brute_variants(dict.fromkeys(words, 1))
    for length in range(1, 8):
        own = [w for w in words if len(w) == length]
        if own:
            who, _ = index.near(index.codes(own, length), 0, 0)
            assert Counter(who.tolist()) == Counter({i: want[w][3] for i, w in enumerate(own) if want[w][3]})


def test_typed_words_against_brute_force(spark, odd, empty):
    rng = random.Random(7)
    rows = [(rng.choice([i, None]), " ".join("".join(rng.choice("aBçÿ×x-") for _ in range(rng.randrange(4, 20))) for _ in range(60))) for i in range(200)]
    want, cut = Counter(), 0
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                cut += 1
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += len(run) >= 6
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(r["word"] for r in spelling.typed_words(df).collect()) == +want and cut > 5
    assert {r["word"]: r["n"] for r in spelling.vocabulary(odd).collect()}["lengthya"] > 1500
    for df in (odd, empty):
        words = spelling.vocabulary(df)
        assert spelling.group_variants(words).count() == words.count()


def brute_rule(url):
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), h + p, v) for v, h, p in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


def test_url_rules_and_edges(spark, odd, empty):
    urls = [
        "http://example.com/en/", "https://WWW.Example.COM/en/1", "http://a.www.example.com/en/2?x=://q/en/", "http://example.com/EN/", "http://example.com",
        "http://xexample.com/en/", "http://com/", "com/", "http://", "://net/fr/#", "ftp://a.net/es/://net/fr/", "http://a.net?/fr/", "http://a.net/fr", None, "", "http://é.net/fr/日本",
    ]
    model = url_filters.train(url_filters.labelled_urls(spark))
    df, names = url_filters.judge_urls(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string"), model)
    for r in df.collect():
        host, path, (rule, verdict) = brute_rule(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["p_block"] > 0.5 else "allow"))
    assert {r["verdict"] for r in df.where("url IS NULL OR url IN ('', 'http://')").collect()} == {"allow"}
    judged, names = url_filters.judge_urls(odd, model)
    assert judged.columns == [*odd.columns, *names] and names[0] == "host_" and judged.count() == odd.count()
    assert judged.where("page_id = 3").first()["rule"] == "net/es/"
    assert url_filters.judge_urls(empty, model)[0].count() == 0
    labels = spark.createDataFrame([("http://a/b", 1.0)], "url string, label double")
    assert url_filters.train(labels) == "block" and url_filters.train(labels.limit(0)) == "allow"


def brute_terms(url):
    host, path, _ = brute_rule(url)
    return {m + f"^{s}$"[i : i + n] for m, s in (("h:", host), ("p:", path)) if s for n in url_filters.GRAMS for i in range(len(s) + 3 - n)}


def test_url_classifier_against_plain_regression(spark):
    """The same objective minimised by gradient descent on unhashed n-grams gives the same probabilities, but for collisions."""
    rows = [(u, 1.0) for u in url_filters.BLOCKED] + [(u, 0.0) for u in url_filters.ALLOWED]
    terms = sorted(set().union(*(brute_terms(u) for u, _ in rows)))
    at = {t: i for i, t in enumerate(terms)}
    x = np.zeros((len(rows), len(terms)))
    for i, (u, _) in enumerate(rows):
        x[i, [at[t] for t in brute_terms(u)]] = 1
    y, w, b = np.array([v for _, v in rows]), np.zeros(len(terms)), 0.0
    for _ in range(20_000):
        e = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        w, b = w - 0.15 * (x.T @ e + url_filters.REGULARIZATION * w), b - 0.15 * e.sum()
    model = url_filters.train(url_filters.labelled_urls(spark))
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id int, url string")
    got = {r["page_id"]: r["p_block"] for r in url_filters.judge_urls(df, model, rules=[])[0].collect()}
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert max(abs(got[i] - p[i]) for i in got) < 0.05


def test_url_classifier_on_held_out_urls(spark):
    rows = [(u, 1.0) for u in url_filters.BLOCKED] + [(u, 0.0) for u in url_filters.ALLOWED]
    random.Random(8).shuffle(rows)
    right = 0
    for fold in range(3):
        train = [r for i, r in enumerate(rows) if i % 3 != fold]
        held = [r for i, r in enumerate(rows) if i % 3 == fold]
        model = url_filters.train(spark.createDataFrame(train, "url string, label double").coalesce(1))
        judged, _ = url_filters.judge_urls(spark.createDataFrame(held, "url string, label double"), model, rules=[])
        right += sum((r["verdict"] == "block") == (r["label"] == 1) for r in judged.collect())
    assert right >= 0.8 * len(rows)
