"""Line dedup, SimHash, mixing and BPE against plain definitions, on hard rows and real ones."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tests.llm.conftest import hard_documents
from vectrail.llm import bpe, components, line_dedup, mixing, simhash
from vectrail.sources.tables import load

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPACE = " \t\n\x0b\f\r"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# ------------------------------------------------------------------ line dedup


def plain_line_dedup(rows, min_docs, keep_first):
    holders = defaultdict(set)
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for i, line in enumerate((text or "").split("\n")):
            key = ascii_lower(line.strip(SPACE))
            holders[key].add(doc_id)
            first.setdefault(key, (doc_id, i))
    out = []
    for doc_id, text in rows:
        kept = []
        lines = (text or "").split("\n")
        for i, line in enumerate(lines):
            key = ascii_lower(line.strip(SPACE))
            gone = key and len(holders[key]) >= min_docs
            if gone and keep_first and first[key] == (doc_id, i):
                gone = False
            if not gone:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("min_docs,keep_first", [(10, False), (2, False), (2, True)])
def test_line_dedup(hard, min_docs, keep_first):
    rows = [r[:2] for r in hard_documents() if not (keep_first and r[0] in (None, 108))]
    df = hard if not keep_first else hard.filter("doc_id IS NOT NULL AND doc_id <> 108")
    got = line_dedup.drop_repeated_lines(df, min_docs, keep_first)
    assert {"score", "component_id"} <= set(got.columns)
    found = got.select("doc_id", "_line_dedup_lines", "_line_dedup_dropped", "_line_dedup_text").collect()
    assert Counter(tuple(r) for r in found) == plain_line_dedup(rows, min_docs, keep_first)


def test_line_dedup_streams_ranges_without_python(spark, folder):
    df = line_dedup.repeated_lines(load(spark, folder, "documents"), 10)
    plan = df._jdf.queryExecution().toString()
    assert "rangepartitioning" in plan and "Window" in plan
    assert "Python" not in plan and "Arrow" not in plan


def test_line_dedup_of_nothing(nothing):
    assert line_dedup.drop_repeated_lines(nothing, 2).count() == 0


def test_many_words_of_a_bitmap(spark):
    text = "\n".join(f"line {i}" if i % 3 else "often" for i in range(1000))
    df = spark.createDataFrame([(i, text if i == 0 else "often") for i in range(12)], "doc_id long, text string")
    row = line_dedup.drop_repeated_lines(df, 10).filter("doc_id = 0").first()
    assert row["_line_dedup_text"] == "\n".join(x for x in text.split("\n") if x != "often")


# --------------------------------------------------------------------- SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    bits = [(hashes >> np.uint64(b)) & np.uint64(1) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * int(bits[b].sum()) > len(hashes))


def plain_components(prints, ids, radius):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius):
            parent[find(i)] = find(i + 1 + int(j))
    name = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            name[find(i)] = min(name.get(find(i), doc_id), doc_id)
    return [name.get(find(i)) for i in range(len(ids))]


def test_simhash_on_hard_rows(hard):
    rows = hard_documents()
    prints = np.array([plain_fingerprint(r[1]) for r in rows], np.uint64)
    names = plain_components(prints, [r[0] for r in rows], 4)
    want = Counter((r[0], f"{int(p):016x}", n) for r, p, n in zip(rows, prints, names))
    found = simhash.near_duplicates(hard).select("_id", simhash.fingerprint_text(), "component_id").collect()
    assert Counter(tuple(r) for r in found) == want


def test_simhash_on_documents(spark, folder):
    rows = load(spark, folder, "documents").select("doc_id", "text").collect()
    prints = np.array([simhash.fingerprint(r["text"].encode()) for r in rows], np.uint64)
    assert all(plain_fingerprint(r["text"]) == int(p) for r, p in list(zip(rows, prints))[:50])
    names = plain_components(prints, [r["doc_id"] for r in rows], 4)
    found = {r["_id"]: r["component_id"] for r in simhash.near_duplicates(load(spark, folder, "documents")).collect()}
    assert found == {r["doc_id"]: n for r, n in zip(rows, names)}


@pytest.mark.parametrize("radius", [2, 4])
def test_ball_hashing_finds_all_pairs_within_the_radius(spark, radius):
    random.seed(radius)
    centres = [random.getrandbits(64) for _ in range(40)]
    prints = set(centres)
    for centre in centres:
        at = centre
        for _ in range(random.randrange(12)):
            for bit in random.sample(range(64), random.randrange(1, 7)):
                at ^= 1 << bit
            prints.add(at)
    values = np.array(sorted(prints), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "_fp long")
    edges = simhash.linked_fingerprints(df, radius)
    found = {r["node"]: r["root"] for r in components.connected_components(edges, "a", "b").collect()}
    ids = values.view(np.int64).tolist()
    want = plain_components(values, ids, radius)
    assert [found.get(i, i) for i in ids] == want


@pytest.mark.parametrize("most", [1 << 22, 30_000, 500])
def test_prints_with_one_lead_are_cut_until_parts_are_small(spark, most):
    # A family: all prints begin alike, a few of the last bits differ; the first bit is set, as the sign.
    random.seed(9)
    base = random.getrandbits(64) | 1 << 63
    values = np.array(sorted({base ^ (random.getrandbits(14) << 3) for _ in range(150)} | {random.getrandbits(64) for _ in range(20)}), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "_fp long")
    parts = Counter()
    for r in simhash._parts(df, 6, 2, most).collect():
        low = 64 - r["_bits"]
        used = ((r["_fp"] % 2**64 >> low) ^ (r["_lead"] % 2**64)).bit_count()
        parts[r["_bits"], r["_lead"]] += len(simhash._flips(low, 2 - used))
    assert max(parts.values()) <= most and sum(parts.values()) == 2081 * len(values)
    edges = simhash.linked_fingerprints(df, 4, most)
    found = {r["node"]: r["root"] for r in components.connected_components(edges, "a", "b").collect()}
    ids = values.view(np.int64).tolist()
    assert [found.get(i, i) for i in ids] == plain_components(values, ids, 4)


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.linked_fingerprints(spark.createDataFrame([(1,)], "_fp long"), 3)


def test_simhash_of_nothing(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each(nothing).count() == 0


def test_one_of_each_keeps_columns_and_rows_without_id(hard):
    kept = simhash.one_of_each(hard)
    assert kept.columns == hard.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(108) == 1 and ids.count(None) == 2
    assert 103 in ids and 104 not in ids  # near copies of a very long text
    assert ids.count(100) + ids.count(101) + ids.count(102) == 1  # no words


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000), (None, 7)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["root"] for r in found} == {
        **{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(400)}
    }


# ---------------------------------------------------------------------- mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= level * weight[s]}
        if not full:
            out.update({s: level * weight[s] for s in open_})
            break
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def check_mix(mixed, rows):
    size_of = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes, longest = Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += size_of(text)
        longest[source] = max(longest[source], size_of(text))
    goals = plain_targets(sizes)
    taken = Counter()
    found = mixed.collect()
    assert Counter((r["doc_id"], r["source"], r["_mix_size"]) for r in found) == Counter(
        (d, s, size_of(t)) for d, t, s in rows
    )
    for r in found:
        assert r["_mix_source_size"] == sizes[r["source"]]
        assert r["_mix_target"] == pytest.approx(goals[r["source"]])
        assert 0 <= r["_mix_copies"] <= 2
        taken[r["source"]] += r["_mix_copies"] * r["_mix_size"]
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= longest[source] / 2 + 1
    return {(r["doc_id"], r["source"]): r["_mix_copies"] for r in found}


def test_mixing_on_hard_rows(hard):
    rows = [(r[0], r[1], r[3]) for r in hard_documents()]
    first = check_mix(mixing.mix(hard), rows)
    assert first == check_mix(mixing.mix(hard.repartition(3)), rows)  # reruns agree


def test_mixing_on_documents(spark, folder):
    documents = load(spark, folder, "documents")
    rows = [tuple(r) for r in documents.select("doc_id", "text", "source").collect()]
    mixed = mixing.mix(documents)
    check_mix(mixed, rows)
    copies = mixing.copies_of(mixed)
    assert copies.columns == documents.columns
    assert copies.count() == sum(r["_mix_copies"] for r in mixed.collect())


def test_rates_are_exponentially_tilted(spark, folder):
    # log(rate) / size is one number per source, except at the limit.
    slope = defaultdict(set)
    for r in mixing.mix(load(spark, folder, "documents")).collect():
        if r["_mix_size"] and r["_mix_rate"] < 2:
            slope[r["source"]].add(round(float(np.log(r["_mix_rate"])) / r["_mix_size"], 9))
    assert slope and all(len(s) == 1 for s in slope.values())


def test_mixing_of_nothing_and_of_no_words(spark, nothing):
    assert mixing.mix(nothing).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["_mix_target"], r["_mix_size"]) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


# ------------------------------------------------------------------------- BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.tokenizer(PATH)


def test_bpe_on_hard_rows(hard, library):
    decoded = bpe.decode(bpe.encode(hard, PATH), PATH)
    found = decoded.select("doc_id", "text", "score", "token_ids", "decoded").collect()
    assert len(found) == hard.count()
    for r in found:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert list(r["token_ids"]) == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False) == (r["text"] or "")


def test_bpe_on_random_texts(own, library):
    parts = ["a", "th", "e", " ", "  ", "\n", "\t", "\xa0", "é", "ß", "日本", "🙂", "1", "23", "'s", "'ll", "..."]
    parts += ["<|endoftext|>", "<|endof", "\x1c", " ", "ا", "́", "ab" * 20, "=", "\x00", "\U00010940"]
    draw = random.Random(3)
    for _ in range(1500):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(40)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("alphabet", ["a", "ab", "aeioutnsr", "=-", "日本語"])
def test_bpe_streams_one_long_piece(own, library, alphabet):
    draw = random.Random(4)
    text = "".join(draw.choice(alphabet) for _ in range(20_000))
    transducer, out, kept = bpe.Transducer(own.merges), [], 0
    data = text.encode()
    for start in range(0, len(data), 512):
        out += transducer.feed(data[start : start + 512])
        kept = max(kept, len(transducer.data))
    out += transducer.end()
    assert out == library.encode(text, add_special_tokens=False).ids
    assert kept < 4096 < own.merges.lookahead  # tokens leave as soon as they are settled


def test_decoding_of_any_ids(library):
    draw = random.Random(5)
    machine = bpe.decoder(PATH)
    for _ in range(200):
        ids = [draw.randrange(50257) for _ in range(30)]
        assert machine.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_of_nothing(nothing):
    assert bpe.decode(bpe.encode(nothing, PATH), PATH).count() == 0
    assert bpe.encode_and_decode(nothing, PATH).count() == 0


def test_one_pass_gives_what_two_give(hard):
    once = bpe.encode_and_decode(hard, PATH)
    twice = bpe.decode(bpe.encode(hard, PATH), PATH)
    assert once.columns == twice.columns
    assert Counter(map(str, once.collect())) == Counter(map(str, twice.collect()))


def test_remembered_words_are_bounded_in_bytes(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 3000)
    texts = [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(40)]
    for text in texts * 2:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert own._words.weight < 3000 and len(own._words) <= 12
    own.forget()
    assert not own._words and not own._words.older


def test_pieces_cover_the_text(own):
    text = hard_documents()[-1][1] + " \n x"
    assert hashlib.sha256("".join(bpe.WORDS.findall(text)).encode()).digest() == hashlib.sha256(text.encode()).digest()
