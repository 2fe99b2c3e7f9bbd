"""Every operator against a plain version on small tables, and on odd rows:
nulls, empty and very long texts, ties, repeated rows, empty tables, extra
columns with clashing names."""

import math
import random

import numpy as np
import public_tokenizers
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bourse.llm import bpe, chat, components, embed_dedup, licenses, mixing, order_minhash, pii, quality, queries, toxicity, url_filter
from bourse.llm.common import table

from . import brute

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
#: Names that operators use inside must be harmless in the input.
DOCS = "doc_id long, text string, source string, _text string, _id string, rep string, chunk string, _u string, email string"


def rows_of(name):
    return ds.dataset(f"{SF}/{name}.parquet").to_table().to_pylist()


def docs_frame(spark, texts):
    return spark.createDataFrame([(i, t, "s", "x", "x", "x", "x", "x", "x") for i, t in texts], DOCS)


ODD = [(1, None), (2, ""), (3, "   \n\t "), (None, "no id but words"), (5, "tie tie"), (5, "tie tie"), (6, "a" * 200_000), (7, "word " * 30_000), (8, "été 你好 \U0001f600 \x00 <|endoftext|>  x")]


# ---- 1

PII_TEXTS = [
    "mail a.b+c@x-y.example.com, then a@b.c_d@e.f and @x.y a@b", "10.0.0.255 1.2.3.256 1.2.3.4.5.6.7.8 000.1.2.3 1.2.3", "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 1234",
    "+1 (988) 555-2485 +123 +1((((( +49 170 1234567 8901234567", "x@" * 50 + "y.z", "1" * 5000, "+1 " * 3000, "IBAN DE89 3704 0044 0532 0130 00 ok", "DE88 3704 0044 0532 0130 00", "ssn 123-45-6789",
    "123-45-6789", "call (555) 123-4567", "\U0001f600 a@b.cc \U0001f600 8.8.8.8", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0", "4 1 1 1-1 1 1 1 1 1 1 1 1 1 1 1",
]


def test_pii_matches_plain_patterns(spark):
    rng = random.Random(1)
    noise = ["".join(rng.choice("ab1 2+.-@()%_5") for _ in range(rng.randint(0, 120))) for _ in range(400)]
    texts = [*enumerate(PII_TEXTS + noise, 10), *ODD]
    got = pii.pii_digest(docs_frame(spark, texts)).collect()
    want = sorted((brute.sha(brute.joined(s)), *(len(s[k]) for k in s)) for s in (brute.base_spans(t) for _, t in texts))
    assert sorted((r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == want
    by = {r.doc_id: r.spans for r in got}
    assert by[17].endswith("iban:5:32") and "iban" not in by[18] and "ssn:4:15" in by[19] and "ssn" not in by[20] and "local_phone:5:19" in by[21]


def test_pii_masks_every_span(spark):
    df = docs_frame(spark, [*enumerate(PII_TEXTS, 10), *ODD])
    out = pii.mask_pii(df)
    assert out.columns == df.columns and out.count() == df.count()
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[10].startswith("mail [EMAIL], then [EMAIL][EMAIL] and") or "[EMAIL]" in text[10]
    assert "4111 1111 1111 1111" not in text[12] and "8.8.8.8" not in text[22] and text[1] is None and text[2] == ""
    assert pii.pii_digest(df.limit(0)).count() == 0


def test_pii_ibans_end_by_their_country(spark):
    good = "DE89 3704 0044 0532 0130 00"
    texts = [f"{good} Please pay", "DE89370400440532013000 The", f"{good} BIC COBADEFFXXX", "GB82 WEST 1234 5698 7654 32 USD", "DE89370400440532013000 5 euros", f"to IT99 {good} now", f"REF1 NO99 {good} AND GB82WEST12345698765432 X",
             "DE89370400440532013000X", "DE88370400440532013000 The", "x" * 50 + " DE12" * 2000, "NO9386011117947 A", "account \U0001f600 " + good + " " + good]
    got = {r.doc_id: r.spans for r in pii.pii_digest(docs_frame(spark, enumerate(texts))).collect()}
    ibans = {i: [texts[i][int(s.split(":")[1]):int(s.split(":")[2])] for s in x.split(",") if s.startswith("iban:")] for i, x in got.items()}
    assert ibans == {0: [good], 1: ["DE89370400440532013000"], 2: [good], 3: ["GB82 WEST 1234 5698 7654 32"], 4: ["DE89370400440532013000"], 5: [good], 6: [good, "GB82WEST12345698765432"], 7: [], 8: [], 9: [],
                     10: ["NO9386011117947"], 11: [good, good]}
    masked = {r.doc_id: r.text for r in pii.mask_pii(docs_frame(spark, enumerate(texts))).collect()}
    assert masked[0] == "[IBAN] Please pay" and masked[3] == "[IBAN] USD" and masked[6] == "REF1 NO99 [IBAN] AND [IBAN] X"


# ---- 2

def test_mixing_inverts_poisson(spark):
    df = docs_frame(spark, [(i, "x" * 10) for i in range(4000)]).withColumn("source", F.expr("if(doc_id < 3000, 'hot', if(doc_id < 3900, 'b', null))"))
    out = mixing.mix(df, {"hot": 0.25}, 0.5, 2.0, 3).select("row.doc_id", "row.source", "copy", "copies").collect()
    per = {}
    for r in out:
        per.setdefault(r.source, []).append(r)
    # 2 x 40000 characters: a quarter for hot, the rest by the square root of 9000 and 1000
    for source, share in (("hot", 0.25), ("b", 0.75 * 0.75), (None, 0.75 * 0.25)):
        assert abs(len(per[source]) - share * 8000) < 5 * math.sqrt(share * 8000)
    import hashlib

    rate, want = 0.25 * 80000 / 30000, {}
    for i in range(3000):
        u = int(hashlib.md5(f"3:{i}".encode()).hexdigest()[:13], 16) / 2**52
        k, p, c = 0, math.exp(-rate), math.exp(-rate)
        while c < u:
            k += 1
            p *= rate / k
            c += p
        want[i] = k
    got = {}
    for r in per["hot"]:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {i: k for i, k in want.items() if k}


def test_mixing_odd_rows(spark):
    df = docs_frame(spark, ODD)
    out = mixing.mix(df, {"absent": 0.5}, 0.7, 50.0, 1)
    assert out.select("row.*").columns == df.columns and out.count() > 0
    assert mixing.mix(df.limit(0), {}, 0.7).count() == 0


# ---- 3

def test_embeddings_match_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 16))
    rows = []
    for i in range(400):
        v = base[i % 12] + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.2, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1.0, 1e-3, 50.0])], int(i % 3)))
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)] + [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] + [1.0] * 15, 0), (2003, [None] + [1.0] * 15, 0), (2004, rows[0][1], None),
                                                             (2005, [1.0, 2.0], 0), (2006, [1.0, 2.0], 0), (None, rows[0][1], 0), (3, rows[3][1], rows[3][2]), (2007, [float("inf")] * 16, 0), (2008, [], 0)]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, label int, rep string, n double")
    got = embed_dedup.near_duplicate_vectors(df).collect()
    sound = [(i if r[0] is not None else None, r[1], r[2] if r[0] is not None else None) for i, r in enumerate(rows)]
    links = list(brute.cosine_links(sound))
    degree = np.bincount([i for x in links for i in x], minlength=len(rows))
    ids = {r[0] for r in rows if r[0] is not None}
    comp = brute.components(ids, [(rows[a][0], rows[b][0]) for a, b in links])
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None) == sorted((r[0], int(degree[i]), comp[r[0]], comp[r[0]] == r[0]) for i, r in enumerate(rows) if r[0] is not None)
    assert [(r.n_links, r.kept) for r in got if r.vec_id is None] == [(0, True)]
    assert embed_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_calibration_grows_with_signs():
    for size in (10, 10_000, 10_000_000, 10**12):
        signs, m, count, width = embed_dedup.calibrate(size)
        assert count >= 2 and m <= 2000 and width > 0


# ---- 4

def test_bpe_equals_the_library(spark):
    tok = Tokenizer.from_file(BPE)
    rng = random.Random(4)
    alphabet = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "1", "²", "٣", "'s", "'ll", "'", "!", "_", "你", "\U0001f600", "\u0301", "<|endoftext|>", "\x85", "\x1c", "\x00", "\u200b", "the"]
    texts = [*ODD, *((100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(600))]
    out = bpe.decode(bpe.encode(docs_frame(spark, texts), BPE), BPE).collect()
    ids = [tok.encode(t or "", add_special_tokens=False).ids for _, t in texts]
    assert sorted((r.doc_id or 0, tuple(r.ids), r.text) for r in out) == sorted((i or 0, tuple(x), tok.decode(x, skip_special_tokens=False)) for (i, _), x in zip(texts, ids))
    assert bpe.bpe_digest(docs_frame(spark, []), BPE).count() == 0


# ---- 5

def test_licenses_exact_and_modified(spark):
    apache = licenses.TEMPLATES["Apache-2.0-notice"]
    texts = [(1, "Some words.\nReleased under the MIT License.\nmore words"), (2, f"x\n{apache}\nend"), (3, apache.replace("obtain a copy", "get one copy")), (4, "A licence to drive. No other words."),
             (5, "é " * 50 + "\nLicensed under CC BY-NC 4.0."), (6, "nothing"), (7, licenses.TEMPLATES["BSD-3-Clause"]), (8, licenses.TEMPLATES["MIT-text"].replace("free of charge", "at no charge"))]
    got = {r.doc_id: r for r in licenses.scan_licenses(docs_frame(spark, texts + ODD)).collect()}
    assert sorted(got) == [1, 2, 3, 5, 7, 8]
    assert {i: (r.license, r.status) for i, r in got.items()} == {1: ("MIT", "exact"), 2: ("Apache-2.0-notice", "exact"), 3: ("Apache-2.0-notice", "modified"), 5: ("CC-BY-NC-4.0", "exact"), 7: ("BSD-3-Clause", "exact"), 8: ("MIT-text", "modified")}
    assert got[3].lacks.split() == ["obtain", "a"] and got[3].besides.split() == ["get", "one"] and (got[1].start, got[1].end) == (12, 43)
    text = dict(texts)
    assert text[5][got[5].start:got[5].end] == "Licensed under CC BY-NC 4.0."


def test_licenses_in_long_blocks_and_side_by_side(spark):
    rng = random.Random(5)
    some = lambda n: " ".join("".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 9))) for _ in range(n))
    mit, apache, full = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0"], licenses.TEMPLATES["MIT-text"]
    inside = "released under the mit license"
    texts = [(n, f"{some(n // 2)} {inside} {some(n - n // 2)}.") for n in (10, 20, 30, 120, 1000)]
    texts += [(1, f"{mit}\n{apache}\n"), (2, f"{full}\n{some(4)}\n{licenses.TEMPLATES['BSD-3-Clause']}\n{mit}\n{mit}"), (3, "\n".join(f"copyright license {some(20)}" for _ in range(200)) + f"\n{apache}\n" + "\n".join(f"permission {some(20)}" for _ in range(200))),
              (4, licenses.TEMPLATES["BSD-3-Clause"].replace("endorse", "praise")), (5, "released the licence under which mit students work, a license")]
    got = {}
    for r in licenses.scan_licenses(docs_frame(spark, texts)).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end, r.license, r.status))
    text = dict(texts)
    assert {i: [x[2:] for x in sorted(v)] for i, v in got.items()} == {
        **{n: [("MIT", "exact")] for n in (10, 20, 30, 120, 1000)}, 1: [("MIT", "exact"), ("Apache-2.0", "exact")],
        2: [("MIT-text", "exact"), ("BSD-3-Clause", "exact"), ("MIT", "exact"), ("MIT", "exact")], 3: [("Apache-2.0", "exact")], 4: [("BSD-3-Clause", "modified")]}
    assert text[120][got[120][0][0]:got[120][0][1]] == inside and [text[1][a:b] for a, b, _, _ in sorted(got[1])] == [mit, apache]


# ---- 6

def insult_corpus(n=900):
    rng = random.Random(6)
    syllables = "tha ren ing dor mek lun pas ver ost ael".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    out = []
    for i in range(n):
        words, y = [word() for _ in range(rng.randint(10, 60))], int(i % 4 == 0)
        for _ in range(rng.randint(1, 4) if y else 0):
            w = rng.choice(["blorfig", "zquimp", "vuxnarg"])
            if i >= 600:  # gaps and insertions that training never sees
                k = rng.randint(2, len(w) - 2)
                w = " ".join(w) if rng.random() < 0.3 else w[:k] + rng.choice(["x", "-", "*", "hh"]) + w[k:]
            words.insert(rng.randint(0, len(words)), w)
        out.append((i, " ".join(words), y))
    return out


def test_toxicity_learns_gapped_insults(spark):
    rows = insult_corpus()
    model = toxicity.fit([r[1] for r in rows[:600]], [r[2] for r in rows[:600]])
    out = {r.doc_id: r for r in toxicity.score_documents(docs_frame(spark, [(i, t) for i, t, _ in rows[600:]] + ODD[:4]), model).collect()}
    right = sum((out[i].predicted == 1) == (y == 1) for i, _, y in rows[600:])
    assert right >= 0.95 * 300 and out[1].predicted == 0 and all(0 <= r.score <= 1 for r in out.values())
    assert all(r.held_out == brute.held_out(i) for i, r in out.items() if i is not None)


def test_toxicity_kernel_is_the_subsequence_kernel():
    from itertools import combinations

    def plain(s, t):
        feats = []
        for x in (s, t):
            f = {}
            for at in combinations(range(len(x)), toxicity.ORDER):
                u = "".join(x[i] for i in at)
                f[u] = f.get(u, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
            feats.append(f)
        return sum(v * feats[1].get(u, 0) for u, v in feats[0].items())

    words = ["idiot", "idxiot", "trash", "stoat", "abcabc"]
    assert np.allclose(toxicity.kernel(words, words), [[plain(a, b) for b in words] for a in words], rtol=1e-4)
    assert np.allclose(toxicity.kernel(words), [plain(a, a) for a in words], rtol=1e-4)


def test_toxicity_odd_rows(spark):
    df = docs_frame(spark, ODD)
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train(df, nothing) is None
    assert {r.score for r in toxicity.score_documents(df, None).collect()} == {0.0}
    assert toxicity.keep_clean(df, None).count() == len(ODD) and toxicity.keep_clean(df, None).columns == df.columns
    rows = insult_corpus(200)
    many = docs_frame(spark, [(i, t) for i, t, _ in rows] + ODD)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] * 2 + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(many, labels)
    assert toxicity.keep_clean(many, model).count() < many.count()


# ---- 7

def test_urls_match_plain_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x?y#z", "http://example.net/en", "http://example.net/en/", "https://x.net", "https://x.net?/a", "https://x.net/", "ftp://b.example.com/de/1", "http://example.com/DE/", "http://org/fr/",
            "http://a.org/fr/x://y", "//net/", "http:///de/", "http://net/" + "a" * 50_000, "http://ÄB.net/", "http://user@h.net:80/p", "http://xnet/", "http://x.net/\n?q"]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(3, urls[3], "<html>")]
    out = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), url_filter.rules_table(spark, queries.URL_RULES)).collect()
    want = []
    for i, u, _ in rows:
        host, path = brute.host_path(u)
        rule, action = brute.best_rule(host, path, queries.URL_RULES)
        want.append((i, host, path, rule or "", action or "allow"))
    assert sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in out) == sorted(want)


def test_url_decisions_spread_over_redirects(spark):
    link = '<link href="{}" rel="canonical">'
    rows = [(1, "http://a.de/1", link.format("http://b.de/1")), (2, "http://b.de/1", '<meta content="0; url=http://spam.net/x" http-equiv=refresh>'), (3, "http://c.de/", "x"), (4, "http://d.de/q?x=1", link.format("/canon")),
            (5, "http://d.de/canon", link.format("//ok.example.net/en/x")), (6, "http://d.de/other", None), (7, "http://e.de/", None), (8, "http://f.de/", None)]
    redirects = spark.createDataFrame([("http://d.de/canon", "http://bad.net/"), ("http://e.de/", "http://f.de/"), ("http://f.de/", "http://worse.net/"), (None, "http://bad.net/")], "from_url string, to_url string")
    out = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), url_filter.rules_table(spark, queries.URL_RULES), redirects)
    assert {r.page_id: (r.verdict, r.reason) for r in out.collect()} == {1: ("block", "alias"), 2: ("block", "alias"), 3: ("allow", "default"), 4: ("allow", "alias"), 5: ("allow", "alias"), 6: ("allow", "default"), 7: ("block", "alias"), 8: ("block", "alias")}


def test_components_match_union_find(spark):
    rng = random.Random(9)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)] + [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == brute.components({x for p in real for x in p}, real)


# ---- 8

def test_near_duplicates_match_all_pairs(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts, i = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                k = rng.randrange(len(w))
                w[k:k + rng.randint(0, 1)] = [word()] * rng.randint(0, 2)
            texts.append((100 + (i := i + 1), " ".join(w)))
    texts += [(900, "same five words right here"), (901, "same five words right here"), (902, "two words"), (903, "two words"), (904, "two  words")]
    all_rows = texts + ODD
    got = order_minhash.near_duplicates(docs_frame(spark, all_rows)).collect()
    seqs = {i: brute.shingles(t) for i, t in all_rows if i is not None and t}
    ids = sorted(seqs)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if min(len(seqs[a]), len(seqs[b])) >= 0.8 * max(len(seqs[a]), len(seqs[b])) and set(seqs[a]) & set(seqs[b])
             and brute.alignment(seqs[a], seqs[b]) >= 0.8 - 1e-9]
    comp = brute.components({i for i, _ in all_rows if i is not None}, pairs)
    assert {(r.doc_id, r.class_id, r.kept) for r in got if r.doc_id is not None} == {(i, c, i == c) for i, c in comp.items()}
    assert len(got) == len(all_rows) and [r.kept for r in got if r.doc_id is None] == [True]
    df = docs_frame(spark, all_rows)
    kept = order_minhash.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, c in comp.items() if i == c} | {None}
    assert order_minhash.near_duplicates(docs_frame(spark, [])).count() == 0


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a = rng.permutation(60)[:rng.integers(20, 50)].astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 4)))
        b = np.insert(b, rng.integers(0, len(b)), rng.integers(100, 110)).astype(np.uint64)
        want = brute.alignment(a.tolist(), b.tolist())
        assert order_minhash.aligned(a, b) == pytest.approx(want if want >= 0.8 else order_minhash.aligned(a, b))
        assert (order_minhash.aligned(a, b) >= 0.8 - 1e-9) == (want >= 0.8 - 1e-9)


def repeated_lines(rng, n, own, lines, words):
    """A text with own words and one line repeated, and copies of it with one
    word of one line changed, a line dropped and a line put in."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    line = [word() for _ in range(words)]
    rows = [[word() for _ in range(own)]] + [list(line) for _ in range(lines)]
    if n % 2:
        rows = [r for k in range(lines) for r in (list(line), [word() for _ in range(12)])]
    at = 2 * rng.randrange(len(rows) // 4)
    at += not n % 2
    changed = [list(r) for r in rows]
    changed[at][words // 2] = word()
    return [rows, changed, rows[:at] + rows[at + 1:], rows[:at] + [line] + rows[at:]]


def test_near_duplicates_with_repeated_lines(spark):
    rng = random.Random(88)
    texts = []
    for n, size in enumerate([(150, 15, 12), (0, 12, 8), (150, 30, 12), (0, 20, 6), (100, 10, 10), (0, 30, 7)]):
        texts += [(100 * n + k, "\n".join(map(" ".join, rows))) for k, rows in enumerate(repeated_lines(rng, n, *size))]
    seqs = {i: [s for s, _ in brute.shingles(t)] for i, t in texts}
    hashes = order_minhash.WordHashes()
    pairs, lost = [], 0
    for i, (a, ta) in enumerate(texts):
        for b, tb in texts[i + 1:]:
            want = brute.alignment(seqs[a], seqs[b])
            got = order_minhash.aligned(order_minhash.shingles(ta, hashes), order_minhash.shingles(tb, hashes))
            assert got == pytest.approx(want) if want >= 0.8 else got < 0.8
            if want >= 0.8:
                pairs.append((a, b))
                lost += brute.alignment(brute.shingles(ta), brute.shingles(tb)) < 0.8
    assert lost >= 6  # the labels in place of the shingles lose these
    comp = brute.components([i for i, _ in texts], pairs)
    assert {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs_frame(spark, texts)).collect()} == comp


def test_alignment_of_repeated_shingles():
    rng = np.random.default_rng(88)
    for _ in range(300):
        a = rng.integers(0, rng.integers(2, 40), rng.integers(1, 90)).astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 6)))
        b = np.insert(b, rng.integers(0, len(b) + 1, 3), rng.integers(0, 60, 3)).astype(np.uint64)
        want = brute.alignment(a.tolist(), b.tolist())
        got = order_minhash.aligned(a, b)
        assert got == pytest.approx(want) if want >= 0.8 - 1e-9 else got < 0.8 - 1e-9


# ---- 9

def test_quality_counts_match(spark):
    rng = random.Random(9)
    texts = [*ODD, *((50 + i, "".join(rng.choice(["a ", "b ", "c\n", "\n", "d#", "x\x0b", "e\u00a0f ", "| "]) for _ in range(rng.randint(0, 200)))) for i in range(150))]
    out = quality.judge(docs_frame(spark, texts), None).collect()
    want = sorted(brute.quality_counts(t) for _, t in texts)
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == want
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and r.kept == (not r.base_failed) for r in out)
    assert quality.judge(docs_frame(spark, []), None).count() == 0


def test_quality_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    train, rest = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    out = quality.judge(docs, quality.train(docs, train)).join(rest.select("doc_id"), "doc_id").collect()
    good = {r["doc_id"] for r in rest.where("quality = 1").collect()}
    judged = [r for r in out if not r.base_failed]
    assert sum(r.kept for r in judged if r.doc_id in good) >= 0.97 * sum(r.doc_id in good for r in judged)
    bad = [r for r in judged if r.doc_id not in good]
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


# ---- 10

def chat_rows():
    rng = random.Random(10)
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 30)):
            role = "system" if t == 0 and c % 2 else rng.choice(["user", "assistant", "assistant"])
            rows.append((c, t, role, rng.choice(["<|im_end|>\n", "<\\|x", "<", "\\", "|", "word " * rng.randint(0, 400), "é\U0001f600"]) + rng.choice(["", "<|im_start|>assistant\n", "<\\\\|"])))
    return rows + [(50, 0, None, None), (50, 1, "assistant", None), (50, 1, "assistant", None), (51, None, "we\\ird\nrole<|", "x"), (None, 1, "user", "no id"), (52, 0, "system", "s"), (53, 0, "assistant", "y " * 20_000), (53, 1, "assistant", "z")]


def test_chat_reads_back(spark):
    rows = chat_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, window string")
    got = {r.conv_id: r for r in chat.chat_digest(df).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t if t is not None else -1, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(turns), brute.sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), brute.sha(loss)), c


def test_chat_windows_keep_budget_system_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, ("user", "assistant")[t % 2], "w " * 90) for t in range(1, 61)]
    w = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 500, 200).orderBy("window").collect()
    assert len(w) > 5 and sum(r.n_new for r in w) == 61 and sum(len(r.loss) for r in w) == 30
    for k, r in enumerate(w):
        assert r.text.startswith("<|im_start|>system\nbe kind<|im_end|>") and r.n_system == (k > 0) and (k == 0 or 1 <= r.n_history <= 3) and r.n_new <= 7
        assert all(r.text[s.start:s.end] == "w " * 90 for s in r.loss)
    assert chat.windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_windows_of_a_long_conversation(spark):
    """Conversations over many segments, against windows cut one by one."""
    rng = random.Random(3)
    turns = [(c, i, "system" if i == 0 and c % 2 else ("user", "assistant")[i % 2], "w " * rng.choice((0, 3, 40, 90, 700))) for c in range(3) for i in range(1200)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.window): (r.text, r.n_system, r.n_history, r.n_new) for r in chat.windows(df, 300, 80).collect()}
    want = {}
    for c in range(3):
        first, rows = 0, []
        for _, i, role, text in turns[c * 1200:(c + 1) * 1200]:
            rows.append((first, first // 300, role, f"<|im_start|>{role}\n{text}<|im_end|>\n"))
            first += len(text.split()) + 4
        for w in sorted({r[1] for r in rows}):
            new = [r for r in rows if r[1] == w]
            system = [r for r in rows[:1] if r[2] == "system" and w > 0]
            history = [r for r in rows[len(rows[:1] if rows[0][2] == "system" else []):] if r[1] < w and r[0] >= new[0][0] - 80]
            want[c, w] = ("".join(r[3] for r in system + history + new), len(system), len(history), len(new))
    assert got == want
    digests = {r.conv_id: (r.n_turns, r.turns_sha256) for r in chat.chat_digest(df).collect()}
    assert digests == {c: (1200, brute.sha("".join(f"{r}\n{t}\n" for k, _, r, t in turns if k == c))) for c in range(3)}
