"""Host reputation, filter interaction and ball-tree search, against brute force and on odd tables."""

from __future__ import annotations

import base64
import gzip
import io
import math
import random
import re
import tarfile
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from postlake.llm import balltree, interaction, pieces, reputation, secrets, toxicity
from postlake.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, host string, said string"


def test_urls_are_split_and_ruled(spark):
    urls = {1: "https://WWW.Example.com/en/a?x=/b#c", 2: "http://example.com/en/", 3: "ftp://a.example.com?/en/", 4: "no address", 5: None, 6: "",
            7: "x://net/es/1", 8: "x://a.b.net/fr", 9: "x://planet/es/", 10: "x://shop.com/", 11: "a://b://c/d", 12: "x://" + "a." * 50_000 + "net/es/"}
    pages = spark.createDataFrame([(i, u, None, "clash", "clash") for i, u in urls.items()] + [(None, urls[2], None, None, None)], PAGES)
    rows = {r.page_id: r for r in reputation.judge(pages, URL_RULES).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert (rows[2].rule, rows[2].verdict) == ("example.com/en/", "block") == (rows[None].rule, rows[None].verdict)
    assert (rows[3].host, rows[3].path, rows[3].rule) == ("a.example.com", "", None)
    assert all((rows[i].host, rows[i].path, rows[i].rule) == ("", "", None) for i in (4, 5, 6))
    assert rows[7].rule == "net/es/" and rows[8].rule is None and rows[9].rule is None and rows[10].rule == "com/"
    assert (rows[11].host, rows[11].path) == ("b:", "//c/d") and rows[12].rule == "net/es/"
    assert all(r.verdict in ("allow", "block") for r in rows.values())
    assert reputation.judge(pages.limit(0), URL_RULES).count() == 0


def test_registered_domains(spark):
    hosts = spark.createDataFrame([("a.b.example.co.uk:80",), ("example.com",), ("u@x.example.com",), ("10.0.0.1:99",), ("com",), ("",)], "host string")
    domain, suffix = reputation.registered(F.col("host"), ("co.uk",))
    assert [tuple(r) for r in hosts.select(domain, suffix).collect()] == [
        ("example.co.uk", "co.uk"), ("example.com", "com"), ("example.com", "com"), ("10.0.0.1", ""), ("com", "com"), ("", "")]


def test_reputations_shrink_towards_domain_and_suffix(spark):
    rows = [("a.bad.org", True)] * 40 + [("b.bad.org", True)] * 2 + [("c.bad.org", None)] + [("a.good.org", False)] * 40 + [("b.good.org", True)]
    rows += [("new.good.org", None)] + [(f"h{i}.other.net", i % 10 == 0) for i in range(200)] + [("x.net", None)]
    made = {r.host: r for r in reputation.reputations(spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    assert made["a.bad.org"].mean > made["b.bad.org"].mean > 0.6 > made["b.good.org"].mean > 0.3 > made["a.good.org"].mean  # one bad page of one is shrunk far
    assert made["c.bad.org"].mean > 0.5 > made["new.good.org"].mean and made["c.bad.org"].bound < made["a.bad.org"].bound
    assert (made["a.bad.org"].labelled, made["a.bad.org"].bad, made["c.bad.org"].labelled) == (40, 40, 0)
    assert all(0 < r.mean < 1 and r.bound < r.mean for r in made.values())
    outcomes = spark.createDataFrame([(f"http://{h}/", b) for h, b in rows if b is not None], "url string, bad boolean")
    pages = spark.createDataFrame([(1, "http://a.bad.org/"), (2, "http://z.good.org/"), (3, "http://a.good.org/q")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in reputation.judge(pages, [], outcomes).collect()} == {1: "block", 2: "allow", 3: "allow"}


def brute_audit(docs, labels):
    first = {}
    for key, text, _ in docs:
        if key is not None:
            first[text or ""] = min(first.get(text or "", key), key)
    good, toxic = ({k for k, q, t in labels if v(q, t) == 1} for v in (lambda q, t: q, lambda q, t: t))
    rows = []
    for key, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)), "E": key is not None and key > first[text]}
        rows.append((part or "", fails, key is not None and key in good, key is not None and key in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, kept = [r for r in left if r[1][f]], [r for r in left if not r[1][f]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), sum(r[1][f] for r in own) - len(gone), sum(r[1][f] and sum(r[1].values()) == 1 for r in own),
                                                   sum(r[2] for r in gone), sum(r[3] for r in gone), f]
                left = kept
        for key, values in out.items():
            if key[0] == part:
                values[6] = shapley[values[6]] if isinstance(values[6], str) else values[6]
    return out


def test_audit_equals_brute_force(spark):
    draw = random.Random(5)
    texts = [None, "", " ", "ÄÖ é", "A" * 3000, "a b " * 60, " ".join(f"w{i}" for i in range(120)), " ".join(f"W{i}" for i in range(120)) + " #",
             "x\x0by " * 200_000, " ".join(f"w{i}" for i in range(100)), " ".join(["é%"] + [f"w{i}\u00a0b" for i in range(100)])]
    docs = [(draw.choice([*range(40), None]), draw.choice(texts), draw.choice(["en", "de", None, ""])) for _ in range(150)]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1])) for i in range(0, 40, 2)] + [(2, 1, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, lang string, part string, mask int").repartition(7)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    made = {(r.part, r.filter_order, r.step): [r[c] for c in interaction.COUNTS] for r in interaction.audit(frame, marks).collect()}
    assert made == brute_audit(docs, labels) and len(made) == 3 * 600
    many = spark.range(2000).selectExpr("id AS doc_id", "'a b' AS text", "concat('p', id % 300) AS lang")  # more parts than a task holds
    rows = interaction.audit(many, marks.limit(0)).where("filter_order = 'ABCDE' and step = 1").collect()
    assert len(rows) == 300 and sum(r.removed for r in rows) == 2000 and all(r.kept == 0 for r in rows)
    assert interaction.audit(frame.limit(0), marks).count() == 0


def test_fields_do_not_run_over():
    total = (2**62) * interaction.packed(31, True, True) + (2**62 - 1) * interaction.packed(1, True, False)
    made = interaction.unpacked(total)
    first = [i for i, order in enumerate(interaction.ORDERS) if order[0] == "A"][0]
    assert made["removed"][first, 0] == 2**63 - 1 == made["good_lost"][first, 0] and made["toxic_lost"][first, 0] == 2**62 == made["redundant"][first, 1]


def brute_search(docs, items, k):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(key, cut(text)) for key, text in docs]
    held = [(key, Counter(t), len(t)) for key, t in held if t]
    n_docs, words = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, counts, n in held:
            m = 100 - 75 + 75 * n * n_docs // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m)) for t in cut(text) if t in counts)
            if score > 0 and key is not None:
                scores.append((-score, key))
        out += [(item, rank, key, -score) for rank, (score, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    draw = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Ä", "ä", "É\u00a0", "THE", "the", "a-b", "x_y"]
    docs = [(i, " ".join(draw.choice(words) + draw.choice([" ", ",", "\x7f", "\n"]) for _ in range(draw.choice([0, 3, 30, 200])))) for i in range(900)]
    docs += [(2000 + i, docs[5][1]) for i in range(30)] + [(2000, docs[5][1]), (3001, None), (3002, ""), (3003, "--"), (None, docs[6][1]), (3004, "w1 " * 100_000)]
    items = [(i, " ".join(draw.choices(words, k=20))) for i in range(12)] + [(50, None), (51, ""), (52, "unheardof"), (53, docs[5][1]), (54, "w1 w1 THE")]
    frame = spark.createDataFrame([(*d, 1, "q") for d in docs], "doc_id long, text string, n long, terms string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    wanted = brute_search(docs, items, 10)
    found = lambda: sorted((tuple(r) for r in balltree.search(frame, asked).collect()), key=str)
    assert found() == wanted
    monkeypatch.setattr(balltree, "QUERIES", 5)  # several blocks of queries
    assert found() == wanted
    assert balltree.search(frame.limit(0), asked).count() == 0 and balltree.search(frame, asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_tree_bounds_hold_and_prune():
    draw = np.random.default_rng(3)
    begins, at = np.arange(0, 24001, 8), np.concatenate([np.arange(8) + 25 * (i % 8) for i in range(3000)])  # eight groups of like documents
    values = draw.integers(900_000, 10**6, len(at))
    tree = balltree.Tree(np.arange(3000), begins, at, values, 200)
    queries = np.zeros((20, 200), dtype=np.int64)
    for q in queries:
        q[draw.choice(8, 5, replace=False) + 25 * draw.integers(8)] = draw.integers(1, 10_000, 5)
    bounds, whole = tree.bounds(queries), sum(c is None for c in tree.children)
    seen = 0
    for q, bound in zip(queries, bounds):
        scores = np.add.reduceat(tree.values * q[tree.at], tree.begins[:-1])
        assert all(scores[lo:hi].max() <= bound[node] for node, (lo, hi) in enumerate(tree.spans))
        best, leaves = tree.search(q, bound, 10)
        assert sorted(best, key=lambda e: (-e[0], e[1])) == sorted(zip(scores.tolist(), tree.keys.tolist()), key=lambda e: (-e[0], e[1]))[:10]
        seen += leaves
    assert seen < 0.7 * whole * len(queries)


def found_in(text):
    spans, refused = secrets.worklist(text)
    return [s for s, _ in spans], refused


def test_secrets_in_binary_wrapped_and_wide_layers():
    secret, draw = b"password=hunter2000", random.Random(6)
    noise = bytes(draw.randrange(128, 256) for _ in range(3000))
    packed = gzip.compress(noise + secret + noise)
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as tar:
        info = tarfile.TarInfo("settings")
        info.size = len(noise) + len(secret) + 2
        tar.addfile(info, io.BytesIO(noise + b"\n" + secret + b"\n"))
    for data in (packed, out.getvalue(), zlib.compress(noise + gzip.compress(noise + secret))):
        run = base64.b64encode(data).decode()
        spans, refused = found_in(f"a {run} b")
        assert not refused and any(k == 0 and a >= 2 and b <= 2 + len(run) for a, b, k in spans)
        wrapped = base64.encodebytes(data).decode()
        spans, _ = found_in("head\n" + wrapped + "\ntail of the text")
        assert any(k == 0 and a >= 5 and b <= 5 + len(wrapped) for a, b, k in spans)
    for end in ("\n", "\r\n  "):  # plain text over a line end: the span reaches over it
        lines = base64.b64encode(b"x" * 50 + secret + b" and more of it " * 4).decode()
        text = end.join(lines[i:i + 76] for i in range(0, len(lines), 76))
        spans, _ = found_in(text)
        assert any(a < 76 < b and k == 0 for a, b, k in spans)
        assert "[S]" in secrets.mask(text, spans, "[S]")
    for code in ("utf-16-le", "utf-16-be", "utf-16"):
        run = base64.b64encode(f"set token: abcdef123456 é ok {code}".encode(code)).decode()
        spans, _ = found_in(run)
        assert any(k == 0 and b - a <= 70 for a, b, k in spans), code


def brute_base(text):
    """Base matches written out by hand: leftmost, non-overlapping, per kind."""
    out, names = [], ("password", "passwd", "secret", "token", "apikey", "api_key")
    run = lambda at, allowed: next((i for i in range(at, len(text)) if text[i] not in allowed), len(text))
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    i = 0
    while i < len(text):
        name = next((n for n in names if low.startswith(n, i)), None)
        if name:
            at = i + len(name)
            at += at < len(text) and text[at] in "\"'"
            at = run(at, " ")
            if at < len(text) and text[at] in ":=":
                at = run(at + 1, " ")
                at += at < len(text) and text[at] in "\"'"
                end = run(at, value)
                if end > at:
                    if end - at >= 6:
                        out.append((i, end, 0))
                    i = end
                    continue
        i += 1
    for kind, start, allowed, least in ((1, "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20), (2, "", set("0123456789abcdef"), 24)):
        i = 0
        while i < len(text):
            end = run(i + len(start), allowed) if text.startswith(start, i) else i
            if end > i + len(start):
                if end - i >= least:
                    out.append((i, end, kind))
                i = end
            else:
                i += 1
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_brute_force(spark):
    draw = random.Random(9)
    bits = ["password", "PassWD", "secret", "api_key", "APIKEY", "token", '"', "'", " ", "  ", ":", "=", "==", "AKIA", "AKIAAKIA", "ABCDEFGH12345678", "0123456789abcdef",
            "deadbeefdeadbeefdeadbeef", "hunter2000", "short", "é", "\n", "%41", "z", "x" * 20]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(40))) for _ in range(400)]
    for text in texts:
        assert secrets.scan(text) == brute_base(text), text


def test_long_texts_train_the_classifier(spark):
    draw = random.Random(12)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(120):
        own = [draw.choice(words) for _ in range(4500)]
        if i % 2:
            own = [w if draw.random() > 0.05 else draw.choice(["loathsome", "despicable"]) for w in own]
        rows.append((i, " ".join(own)))
        labels.append((i, 1, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert min(len(t) for _, t in rows) > 20_000
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.col("doc_id") < 80)
    held = toxicity.score(docs.where("doc_id >= 80"), model).collect()
    assert sum((r.score >= 0.5) == bool(r.doc_id % 2) for r in held) >= 0.95 * len(held)
    cut = spark.createDataFrame([("a" * 12_000,), ("b" + "a" * 30_000 + "c",), (None,), ("",)], "t string").select(toxicity.windows_of(F.col("t")).alias("t")).collect()
    assert len(cut[0].t) == 12_000 and cut[1].t[0] == "b" and cut[1].t[-1] == "c" and len(cut[1].t) == 12_011 and cut[2].t is None and cut[3].t == ""


def test_runs_of_spaces_and_long_words_equal_the_library():
    import public_tokenizers
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own, draw = sentencepiece.SentencePieceProcessor(model_file=path), pieces.codec(path), random.Random(2)
    words = ["the", "Straße", "a", "token", "zzzzqqq", "日本", "internationalization", "é", "\n", "12345", "***"]
    cases = [" " * k for k in (1, 2, 3, 17, 64, 511, 512, 513, 514, 1024, 5000)]
    cases += [draw.choice(words) + " " * k + draw.choice(words) for k in (*range(2, 60), 512, 513, 3000)]
    cases += ["  " + "".join(draw.choice("abcdefghij▁é") for _ in range(k)) for k in (1000, 1024, 1025, 3000, 8000)]
    cases += ["".join(draw.choice(words) + " " * draw.choice([0, 1, 2, 3, 8, 16, 33]) for _ in range(10)) for _ in range(500)]
    for text in cases:
        assert own.encode(text) == library.encode(text), text[:80]
