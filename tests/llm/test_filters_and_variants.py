"""URL filters, hard negatives and spelling variants against brute force, on hard rows."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrail.llm import exact, hard_negatives, spelling, url_rules
from tests.llm.conftest import LONG, hard_documents

# ------------------------------------------------------------------ url filters


def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    lower = lambda s: re.sub("[A-Z]", lambda m: m.group().lower(), s)
    host = lower(host)
    best = None
    for h, p, verdict in rules:
        if not h or verdict is None:
            continue
        h, p = lower(h), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h) + len(p), len(h), verdict, h + p))
    return host, path, best and best[3], best[2] if best else default


URLS = [
    None, "", "no scheme", "://", "http://", "http:///only/path", "ftp://x://y/z", "http://NET/", "http://net", "http://nett/",
    "http://a.net/x", "http://a.net?x=/en/", "https://example.net/en/1", "https://EXAMPLE.net/EN/1", "https://www.example.net/en/",
    "https://www.example.net/en", "https://notexample.net/en/1", "https://example.net./en/1", "https://a..net/en/", "http://a-b.net/x",
    "http://example.com/de/1#x", "http://b.example.com:80/de/", "http://b.example.com/de", "http://x.org/fr/", "http://org/fr/q?y",
    "http://müller.example.net/en/ä", "http://a.b.c.d.e.f.net/" + "p/" * 5000, "http://h.example.com/de/\nline", "http://-.net/", "http://example.net/en/a/b",
]
RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("example.net", "/en/a", "block"), ("b.example.com", "/de", "allow"), ("b.example.com", "/de", "block"), ("Example.NET", "/en/a/", "allow"),
    ("f.net", None, "block"), (None, "/", "block"), ("", "/", "block"), ("x.org", "/", None), ("a.net", "/x", "allow"),
]


def judged(spark, urls, rules, **options):
    rows = spark.createDataFrame([(i, u, "p", "q", "r", {"m": 1}) for i, u in enumerate(urls)], "i long, url string, path string, rule string, `_key x` string, m map<string,int>")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = url_rules.judge_urls(rows, table, **options).collect()
    assert len(found) == len(urls) and all(r["row"]["path"] == "p" and r["row"]["_key x"] == "r" for r in found)
    return {r["row"]["i"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}


@pytest.mark.parametrize("paths_per_host", [64, 1, 0])
def test_urls_against_brute_force(spark, paths_per_host):
    got = judged(spark, URLS, RULES, paths_per_host=paths_per_host)
    assert got == {i: plain_verdict(u, RULES) for i, u in enumerate(URLS)}


def test_many_nested_rules_and_a_hot_host(spark):
    """More labels and path lengths than one sweep has slots, and most urls on one host."""
    deep = ".".join(f"l{i}" for i in range(40))
    rules = [(deep.split(".", i)[-1], "/", "block" if i % 2 else "allow") for i in range(40)]
    rules += [("hot.com", "/" + "a" * i, "block" if i % 3 else "allow") for i in range(1, 80)]
    rules += [("com", "/aaab", "allow"), ("sub.hot.com", "/aa", "allow")]
    urls = [f"http://{deep.split('.', i)[-1]}/{i}" for i in range(40)]
    urls += [f"http://{h}hot.com/{'a' * (i % 90)}b?{i}" for i in range(600) for h in ("", "sub.")]
    urls += ["http://hot.com/aaa"] * 500
    got = judged(spark, urls, rules)
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}


def test_no_urls_and_no_rules(spark):
    assert judged(spark, [], RULES) == {}
    assert all(v[2:] == (None, "allow") for v in judged(spark, URLS, []).values())
    assert judged(spark, ["http://a.net/"], [], default="block")[0][3] == "block"


def test_url_filter_runs_no_python(spark):
    rows = spark.range(9).select(F.concat(F.lit("http://a.net/"), F.col("id").cast("string")).alias("url"))
    rules = spark.sql("SELECT 'net' AS host, '/' AS path, 'block' AS verdict")
    plan = url_rules.judge_urls(rows, rules)._jdf.queryExecution().executedPlan().toString()
    for name in ("Python", "Arrow", "Pandas", "ExistingRDD", "CartesianProduct", "NestedLoop"):
        assert name not in plan


# --------------------------------------------------------------- hard negatives


def plain_products(rows):
    return lambda a, b: min(max(sum(x * y for x, y in zip(a, b)), -(1 << 63)), (1 << 63) - 1)


def plain_hard_negatives(rows, anchor, positives=5, negatives=3, low=50, high=95):
    usable = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)
    ]
    score = plain_products(rows)
    asked = {}
    for i, label, v in usable:
        if anchor(i):
            # Labels are compared as text, vectors by component.
            asked[i] = min(asked.get(i, (str(label), v)), (str(label), v))
    out = Counter()
    for a, (label, v) in asked.items():
        scored = [(-score(v, w), i, str(other)) for i, other, w in usable if len(w) == len(v)]
        best = sorted((s, i) for s, i, other in scored if i != a and other == label)[:positives]
        for s, p in best:
            fits = sorted((n, i) for n, i, other in scored if other != label and low * -s <= 100 * -n <= high * -s)
            for rank, (n, i) in enumerate(fits[:negatives]):
                out[(a, p, rank + 1, i, -s, -n)] += 1
    return out


def hard_rows(n=600, dims=6, seed=2):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dims))
    rows = []
    for i in range(n):
        v = centres[i % 12] * draw.choice([0.3, 1.0, 5.0]) + draw.normal(size=dims) * draw.choice([0.02, 0.3])
        rows.append((i, [float(x) for x in v], int(draw.integers(4)) if i % 3 else i % 12 % 4))
    hot = rows[24][1]
    rows += [(10_000 + i, hot, i % 2) for i in range(300)]  # a third of the rows are equal
    rows += [(24, hot, 1), (24, hot, 1), (600, hot, 3), (600, rows[0][1], 1), (700, [0.0] * dims, 1), (701, [0.0] * dims, 2)]
    rows += [(800, [3e5] * dims, 1), (801, [1e15] + [1.0] * (dims - 1), 1), (850, [1e15, -1e15] + [3.0] * (dims - 2), 2), (803, [1e200] * dims, 3)]
    rows += [(900 + i, [float(i % 5), 1.0], i % 3) for i in range(60)]  # another length
    rows += [(1000, None, 1), (1001, [], 1), (1050, [1.0, None], 1), (1100, [float("nan")] * dims, 1), (1150, [float("inf")] * dims, 1)]
    rows += [(None, hot, 1), (1200, hot, None), (1250, [1e307] * dims, 1)]
    return rows


def mined(spark, rows, **options):
    table = spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows], "vec_id long, e array<double>, label int, score string, pack string")
    table = table.withColumn("vector", exact.floored(F.col("e"), 256.0))
    found = hard_negatives.hard_negatives(table.filter("vec_id % 50 = 0"), table, **options)
    return Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize("rows_per_block, anchors", [(4096, 1024), (40, 5)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, rows_per_block, anchors):
    monkeypatch.setattr(hard_negatives, "ROWS", rows_per_block)  # small blocks: many groups and routes
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    rows = hard_rows()
    assert mined(spark, rows, directions=8) == plain_hard_negatives(rows, lambda i: i % 50 == 0)


def test_other_windows_and_no_rows(spark):
    rows = hard_rows(200, seed=5)
    want = plain_hard_negatives(rows, lambda i: i % 50 == 0, 2, 9, -20, 130)
    assert mined(spark, rows, positives=2, negatives=9, low_percent=-20, high_percent=130) == want
    assert mined(spark, []) == Counter()


def test_exact_products():
    a = np.array([[3.0, 4.0], [2.0**60, 1.0], [1e200, 1e200], [0.0, 0.0]])
    got = exact.products(a, a)
    top = (1 << 63) - 1
    assert got.tolist() == [[25, top if 3 * 2**60 + 4 > top else 3 * 2**60 + 4, top, 0], [3 * 2**60 + 4, top, top, 0], [top, top, top, 0], [0, 0, 0, 0]]


# ------------------------------------------------------------- spelling variants


def plain_words(docs, min_chars=7, min_count=2, noise_every=31):
    n = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m.group().lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if noise_every and h % noise_every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= min_chars:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def plain_variants(n, times=10):
    gaps = defaultdict(set)
    for w in n:
        gaps[w].add(w)
        for i in range(len(w)):
            gaps[w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for ws in gaps.values():
        for a in ws:
            near[a] |= {b for b in ws if one_edit(a, b)}
    form = {}
    for w in n:
        if near[w]:
            b = min(near[w], key=lambda x: (-n[x], x))
            if n[b] >= times * n[w]:
                form[w] = b
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root)
    return out


def grouped(counts):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variants(counts).collect()}


def test_variants_on_whole_texts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    n = plain_words([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    counts = spelling.word_counts(docs, noise_every=31)
    assert grouped(counts) == plain_variants(n)


def test_words_of_hard_texts(spark, hard, nothing):
    docs = hard_documents()
    for every in (31, 2, None):
        got = {r["word"]: r["n"] for r in spelling.word_counts(hard, 5, 2, every).collect()}
        assert got == plain_words([(d[0], d[1]) for d in docs], 5, 2, every)
    assert spelling.variants(spelling.word_counts(nothing)).collect() == []


def test_edits_of_every_kind_and_length(spark):
    """Runs of one letter, short and very long words, chains of forms, ties."""
    n = {"a": 3, "aa": 5, "aaa": 40, "aaaa": 1, "b": 500, "": 7, "abab": 3, "baba": 3, "aba": 30, "bab": 30}
    base = "abcdefghij" * 7
    for size in (7, 8, 62, 63, 64, 65, 66, 70):
        w = base[:size]
        n[w] = 1000
        for i in (0, 1, size // 2 - 1, size // 2, size - 2, size - 1):
            n[w[:i] + w[i + 1 :]] = 50
            n[w[:i] + "ÿ" + w[i:]] = 5
            n[w[:i] + "à" + w[i + 1 :]] = 1
    huge = "x" * 40_000 + "y" * 40_000
    n |= {huge: 100, huge[1:]: 5, huge + "y": 1, huge[:-1] + "z": 100, "q" * 64: 9, "q" * 65: 90, "q" * 66: 900}
    rows = spark.createDataFrame(list(n.items()), "word string, n long")
    words = [w for w in n if w]
    got = grouped(rows)
    near = {a: sorted(b for b in words if one_edit(a, b)) for a in words}
    assert {w: got[w][1] for w in words} == {w: len(near[w]) for w in words}
    assert got[""] == (7, 0, None, None, "")
    small = {w: c for w, c in n.items() if w and len(w) < 100}
    want = plain_variants(small)
    assert {w: got[w] for w in small} == want
    assert got[huge + "y"] == (1, 2, huge, 100, huge) or got[huge + "y"][2] == min((huge, huge[:-1] + "z"))


def test_a_common_prefix_and_one_hot_node(spark):
    words = {f"thecommonprefix{i:04d}".translate(str.maketrans("0123456789", "abcdefghij")): 1 + i % 40 for i in range(1500)}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    assert grouped(rows) == plain_variants(words)


def test_requests_cut_a_word_once_and_run_compiled(spark):
    """What states ask of the edges, and that no function is evaluated row by row outside compiled code."""
    rows = [(0, "abba", p, "abba"[:p], e) for p in range(5) for e in (0, 1)]
    asked = spelling._requests(spark.createDataFrame(rows, "way int, word string, pos int, node string, edits int"))
    want = Counter()
    for way, word, p, node, edits in rows:
        padded = word + "$" * 5
        here, after = padded[p], padded[p + 1]
        if edits:
            asks = [(p + 1, here, None)]
        else:
            asks = [(p, None, here)]
            asks += [(p + 1, None, here)] if here != "$" else []
            asks += [(p + 2, after, None)] if here not in ("$", after) else []
        want.update((way, word, node, to, (word + "$$$$")[to : to + 3], *more) for to, *more in asks)
    assert Counter(tuple(r[c] for c in ("way", "word", "node", "pos", "ahead", "want", "skip")) for r in asked.collect()) == want
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and plan.count("concat(") == 1
