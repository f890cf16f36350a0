"""Merkle manifest, lexical search and license scan against plain versions and on edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import lexical_search, license_scan, merkle, queries
from tessera.llm.common import read_table, share_package

SF = "/root/testdata/sf0.001"
LONG = "word " * 60_000
TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "One two MIT License four"), (4, "One two MIT License four"), (5, LONG),
         (None, "no id here"), (None, None), (6, "Größe 漢字 😀 a\x00b licensed under CC BY-NC 4.0")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    share_package(spark)
    rows = [(i, t, None if i == 2 else "en", None, len(t or "")) for i, t in TEXTS]
    return (spark.createDataFrame(rows, DOCS).repartition(3)
            .withColumn("id", F.lit("x")).withColumn("rank", F.lit(7)).withColumn("tree", F.lit(0)).withColumn("row", F.lit(1)))


# ------------------------------------------------------------------ manifest

def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def slow_leaf(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def slow_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 8])) for k in range(0, len(levels[-1]), 8)])
    return levels


def slow_path(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at - at % 8:at - at % 8 + 8]
        out.append((at % 8, run[:at % 8] + run[at % 8 + 1:]))
        at //= 8
    return out


def slow_manifest(rows):
    groups = {}
    for r in rows:
        leaf = slow_leaf(r, r.text)
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
        other = slow_leaf(r, re.sub("[A-Z]", lambda m: m[0].lower(), r.text)) if hit else leaf
        groups.setdefault((b"" if r.lang is None else b"=" + r.lang.encode()), []).append(((r.doc_id is not None, r.doc_id or 0, leaf), other))
    trees = {}
    for name in sorted(groups):
        groups[name].sort()
        trees[name] = slow_tree([k[2] for k, _ in groups[name]])
    top = slow_tree([t[-1][0] for t in trees.values()]) if trees else None
    out = []
    for n, name in enumerate(trees):
        for at, ((has, doc, leaf), other) in enumerate(groups[name]):
            path = slow_path(trees[name], at) + slow_path(top, n)
            node = other
            for place, others in path:
                node = sha("".join(others[:place] + [node] + others[place:]))
            root = top[-1][0]
            out.append((doc if has else None, leaf, trees[name][-1][0], root, sha("".join(d for _, others in path for d in others)), node, node == root))
    return Counter(out)


def test_places_are_those_of_a_postorder_walk():
    for n in [1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 513]:
        levels = [list(range(n))]
        while len(levels[-1]) > 1:
            levels.append(list(range(-(-len(levels[-1]) // 8))))

        def walk(level, index):
            if level:
                for child in range(8 * index, min(8 * index + 8, len(levels[level - 1]))):
                    yield from walk(level - 1, child)
            yield level, index

        assert merkle.height_of(n) == len(levels) - 1
        for place, (level, index) in enumerate(walk(len(levels) - 1, 0)):
            assert merkle.node_place(level, index, n) == place


@pytest.mark.parametrize("height", [4, 1])
def test_manifest_of_documents(spark, height):  # height 1: small segments, several tiers
    share_package(spark)
    docs = read_table(spark, SF, "documents")
    got = Counter(tuple(r) for r in merkle.op11(docs.repartition(3), height).collect())
    assert got == slow_manifest(docs.collect())


def test_manifest_edges(docs, spark):
    rows = docs.collect()
    got = merkle.op11(docs)
    assert got.columns[:7] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in got.collect()) == slow_manifest(rows)
    assert merkle.op11(docs.where("false")).collect() == []
    one = docs.where("doc_id = 3").collect()
    assert Counter(tuple(r) for r in merkle.op11(docs.where("doc_id = 3")).collect()) == slow_manifest(one)
    many = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("T").alias("text"), F.concat(F.lit("l"), "id").alias("lang"),
                                  F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert Counter(tuple(r) for r in merkle.op11(many).collect()) == slow_manifest(many.collect())


# -------------------------------------------------------------------- search

def slow_terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def slow_search(docs, items, k=50):
    tf = [(i, Counter(slow_terms(t))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    total, df, out = sum(sum(c.values()) for _, c in tf), Counter(t for _, c in tf for t in c), []
    for item, text in items:
        scored = []
        for doc, c in tf:
            n = sum(c.values())
            m = 50 + (50 * n * len(tf)) // total
            score = sum(math.floor(1000 * math.log((2 * len(tf) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(slow_terms(text)) if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, n, None if gone else doc, -s) for n, (s, gone, doc) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("block,query_bytes", [(1 << 14, 1 << 25), (7, 2000)])
def test_search(spark, block, query_bytes):
    share_package(spark)
    docs, items = read_table(spark, SF, "documents"), read_table(spark, SF, "benchmark")
    want = slow_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = lexical_search.search(items, docs.repartition(3), query_bytes=query_bytes, block_docs=block)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_search_edges(spark, docs):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(90)]
    many = [(k, " ".join(rng.choice(words[:1 + k]) for _ in range(rng.randint(1, 200)))) for k in range(80)]
    many += [(k, "common " + t) for k, t in TEXTS if t]
    items = [(1, None), (2, ""), (3, " ".join(words)), (3, " ".join(words)), (None, "COMMON four"), (4, "nowhere"), (5, LONG + "common w3"), (6, "größe 漢字")]
    queries_ = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit(1)).withColumn("query", F.lit(2))
    frame = spark.createDataFrame(many, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(2)
    for k in (3, 50):
        got = lexical_search.search(queries_, frame, k)
        assert Counter(tuple(r) for r in got.collect()) == slow_search(many, items, k)
    for left, right in ((queries_.where("false"), frame), (queries_, frame.where("false")), (queries_, frame.where("false").limit(0))):
        assert lexical_search.op12(right, left).collect() == []


def test_groups_below_the_best_are_not_scored(spark):
    docs = [(k, "rare rare rare common") for k in range(60)] + [(100 + k, "common " * 5 + f"f{k}") for k in range(300)] + [(900, "other")] * 500
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    share_package(spark)
    row = lexical_search.pack_documents(df, [b"common", b"rare"], "doc_id", "text").first()
    block = lexical_search.Block({n: bytes(row[n]) for n in lexical_search.TABLES}, {0: 500, 1: 2000}, (row["docs"], row["words"]))
    ids, scores, scored = block.best([0, 1], 50, 1)
    assert sorted(ids) == list(range(50)) and scored == 1 and block.groups([0, 1])[2].shape[1] == 2


# ------------------------------------------------------------------- license

def slow_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    base = [(k, label) for phrase, label in license_scan.PHRASES for p in [phrase.split()] for k in range(len(words)) if words[k:k + len(p)] == p]
    own, score = set(), 1.0 if base else 0.0
    for start in range(0, len(words) + 1, license_scan.STEP):
        block = set(words[start:start + license_scan.SPAN])
        met = {}
        for t, label in license_scan.TEMPLATES:
            share = len(block & set(t.split())) / len(set(t.split()))
            if share >= license_scan.THRESHOLD - 1e-9:
                met[t] = (label, share)
        for t, (label, share) in met.items():
            if not any(set(t.split()) < set(u.split()) for u in met):
                own.add(label)
                score = max(score, share)
    places = [k for k, _ in base]
    return (len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})),
            ",".join(sorted({x for _, x in base} | own)), round(score, 12))


def scanned(rows):
    return Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 12)) for r in rows)


def test_license_scan(spark):
    share_package(spark)
    for sf in (SF, "/root/testdata/sf0.01"):
        docs = read_table(spark, sf, "documents")
        got = scanned(queries.queries()["op13_license_scan"](spark, sf).collect())
        assert got == Counter((r.doc_id, *slow_scan(r.text)) for r in docs.collect())


@pytest.mark.parametrize("pack", [1 << 14, 3])
def test_license_scan_of_mixed_texts(spark, pack):
    share_package(spark)
    rng = random.Random(6)
    texts = [t for t, _ in license_scan.PHRASES + license_scan.TEMPLATES]
    vocabulary = sorted({w for t in texts for w in t.split()})
    rows = []
    for k in range(120):
        parts = []
        for _ in range(rng.randint(0, 12)):
            words = rng.choice(texts).split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary + ["x", "y"])
            parts += words + [rng.choice(vocabulary + ["é1"]) for _ in range(rng.randint(0, 20))]
        rows.append((k, " ".join(w.upper() if rng.random() < .3 else w for w in parts)))
    rows += [(200, "MIT License"), (201, "mit\nlicense mit-license MIT/LICENSE"), (202, "mit x license"), (203, "the " * 15 + "mit license"),
             (204, "the " * 31 + "apache license"), (205, "general public license " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert scanned(license_scan.op13(df, pack).collect()) == Counter((i, *slow_scan(t)) for i, t in rows)


def test_license_scan_edges(docs):
    got = scanned(license_scan.op13(docs).collect())
    assert got == Counter((i, *slow_scan(t)) for i, t in TEXTS)
    assert {k[0]: k[6] for k in got}[6] == "cc-by-nc"
    assert license_scan.op13(docs.where("false")).collect() == []


def test_filters_lose_no_block():
    rng = np.random.default_rng(7)
    index = license_scan.Index(license_scan.PHRASES, license_scan.TEMPLATES, 0.6)
    index.inside = []
    index.order(rng.integers(0, 100, len(index.vocabulary)))
    sets = [np.unique(np.concatenate([rng.choice(np.flatnonzero(index.has[rng.integers(len(index.texts))]), 4),
                                      rng.integers(0, len(index.vocabulary), rng.integers(0, 14))])) for _ in range(400)]
    key = np.repeat(np.arange(400), [len(s) for s in sets])
    got = set(zip(*(x.tolist() for x in license_scan.candidates(key, np.concatenate(sets), index))))
    want = {(b, t, int(index.has[t, s].sum())) for b, s in enumerate(sets) for t in range(len(index.texts)) if index.has[t, s].sum() >= index.need[t]}
    assert got == want
