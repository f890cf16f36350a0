"""Operators against plain versions on the small tables."""

import hashlib
import math
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from tessera.llm import components, embedding_dedup, front_coding, html_extract, piece_codec, quality, queries, simhash, spotsigs, suffix_dedup, token_counts, url_filter
from tessera.llm.common import read_table, share_package

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    share_package(spark)
    return {r.doc_id: r.text or "" for r in read_table(spark, SF, "documents").collect()}


def run(spark, name):
    return queries.queries()[name](spark, SF).collect()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def brute_repeats(texts, width=100):
    seen, out = set(), {}
    for i in sorted(texts):
        raw = texts[i].encode()
        keep = np.ones(len(raw), bool)
        for k in range(len(raw) - width + 1):
            w = raw[k:k + width]
            if w in seen:
                keep[k:k + width] = False
            seen.add(w)
        spans = int((~keep[:1]).sum() + (keep[:-1] & ~keep[1:]).sum())
        out[i] = (len(raw), int((~keep).sum()), spans, sha(np.frombuffer(raw, np.uint8)[keep].tobytes()))
    return out


@pytest.mark.parametrize("hot,block,entries", [(4096, 4 << 20, 1 << 16), (2, 50_000, 1 << 16), (4096, 20_000, 5)])
def test_suffix_dedup(spark, texts, monkeypatch, hot, block, entries):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_ENTRIES", entries)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op2(read_table(spark, SF, "documents").repartition(3)).collect()}
    assert got == brute_repeats(texts)


def test_a_passage_in_every_block(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "SPLIT_SAMPLE", 50)
    rng = random.Random(11)
    passage = " ".join(f"p{rng.randrange(999)}" for _ in range(60))
    rows = {k: " ".join(f"w{rng.randrange(9999)}" for _ in range(100)) + passage + " ".join(f"w{rng.randrange(9999)}" for _ in range(100)) for k in range(40)}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(4)
    want = brute_repeats(rows)
    for entries in (1 << 16, 3):
        monkeypatch.setattr(suffix_dedup, "HOT_ENTRIES", entries)
        assert {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op2(df).collect()} == want


def test_suffix_dedup_of_periodic_and_overlapping_texts(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdef ") for _ in range(400))
    rows = {1: "a" * 350, 2: "ab" * 200, 3: base, 4: base[50:170] + "X" + base[100:260], 5: base[:99], 6: "é" * 120 + base[200:330], 7: "a" * 120, 8: base}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(4)
    assert {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op2(df).collect()} == brute_repeats(rows)


def test_merge_of_front_coded_runs():
    rng = random.Random(1)
    runs, every = [], []
    for n in range(7):
        run_ = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 60)))
        every += run_
        runs.append(front_coding.Run(n, *front_coding.encode(run_)))
    got = list(front_coding.merge(runs))
    assert [g[0] for g in got] == sorted(every)
    for (a, *_), (b, shared, *_) in zip(got, got[1:]):
        assert a[:shared] == b[:shared] and (shared == min(len(a), len(b)) or a[shared] != b[shared])


def test_simhash(spark, texts):
    def slow(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = {i: slow(t) for i, t in texts.items()}
    comp = {i: i for i in fps}
    for _ in fps:
        new = {i: min(comp[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 3) for i in fps}
        if new == comp:
            break
        comp = new
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op10_simhash")} == {i: (f"{fps[i]:016x}", comp[i]) for i in fps}


def test_simhash_of_rows_without_an_id_and_of_repeated_ids(spark):
    from pyspark.sql import functions as F

    def groups(rows):
        df = spark.createDataFrame(rows, "id long, fp long")
        got = df.join(simhash._grouped(df, 3), "fp").select("id", "fp", "component").collect()
        return sorted((str(r.id), r.fp, str(r.component)) for r in got)

    assert groups([(1, 0), (None, 7), (2, 63)]) == [("1", 0, "1"), ("2", 63, "1"), ("None", 7, "1")]
    assert groups([(1, 0), (None, 1)]) == [("1", 0, "1"), ("None", 1, "1")]
    assert groups([(None, 0), (None, 1 << 40), (None, 0)]) == [("None", 0, "None")] * 2 + [("None", 1 << 40, "None")]
    assert groups([(3, 0), (2, 1 << 50), (2, 1), (3, 7)]) == [("2", 1, "2"), ("2", 1 << 50, "2"), ("3", 0, "2"), ("3", 7, "2")]

    share_package(spark)
    rng = random.Random(4)
    a, b, c, d = (" ".join(f"w{rng.randrange(9999)}" for _ in range(80)) for _ in range(4))
    rows = [(1, a), (1, b), (2, c), (1, a), (3, c), (None, c), (None, d), (None, d), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.lit(1)).withColumn("id", F.lit("x")).repartition(3)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted([("1", a), ("1", b), ("2", c), ("None", d), ("4", "")])


def test_simhash_finds_every_pair_within_three_bits(spark):
    rng = random.Random(2)
    fps = [rng.getrandbits(64) for _ in range(60)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for f in fps for _ in range(4)]
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "id long, fp long")
    from pyspark.sql import functions as F

    keyed = df.select(F.explode(F.array(*simhash.ring_keys(F.col("fp")))).alias("k"), "id", "fp")
    for block in (4, 2048):  # with hot buckets cut into blocks, and without
        links = simhash.compare_buckets(keyed, simhash._compare(3), "a long, b long", block)
        got = {r.node: r.component for r in components.connected_components(links).collect()}
        want = list(range(len(fps)))
        for _ in fps:
            want = [min(want[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3) for i in range(len(fps))]
        assert [got.get(i, i) for i in range(len(fps))] == want


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    ids = rng.sample(range(10_000), 300)
    edges = list(zip(ids[:150], ids[1:150])) + [(ids[150], x) for x in ids[151:]] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: min(ids[:150]) for i in ids[:150]} | {i: min(ids[150:]) for i in ids[150:]}
    assert got == {i: c for i, c in want.items() if i != c}


def test_urls_of_any_length(spark):
    share_package(spark)
    rows = [(1, "http://a.com/" + "x" * 1_000_000), (2, "http://" + "loan" * 25_000 + ".com/"), (3, "http://loan-casino.com/a/b"), (4, None),
            (5, "http://good-news.org/" + "/ab12" * 200_000), (6, "http://" + "q" * 200 + ".example/")]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=()).collect()}
    want = slow_url_scores([(got[k].host, got[k].path) for k in range(1, 7)])
    for k, x in enumerate(want, 1):
        assert got[k].score == pytest.approx(x, rel=1e-9, abs=1e-6) and got[k].verdict == ("block" if x > 0 else "allow")
    assert [(len(got[k].host), len(got[k].path)) for k in (1, 2, 5)] == [(5, 1_000_001), (100_004, 1), (13, 1_000_001)]


def test_every_code_point_is_split_as_the_tokenizer_does():
    path = token_counts.tokenizer_path()
    pre = token_counts._tokenizer(path)[0].pre_tokenizer
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    plain = [c for c in points if not token_counts.NOT_PLAIN.search(c)]
    assert len(plain) > 48_000
    # one text of many: each code point beside a letter, a digit, a space and a symbol
    for at in range(0, len(plain), 5000):
        text = "".join(f"a{c}1{c} {c}!{c}\n" for c in plain[at:at + 5000])
        assert token_counts.pre_tokens(text, path) == [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)]
    t = Tokenizer.from_file(path)
    for text in ("\U00016ea7's", "a\u0558b", "x<|endoftext|>\u088f1 \u0c5c", "\U0003d000 \u208f9"):
        words = token_counts.pre_tokens(text, path)
        assert sum(token_counts.count_pieces(words, path)) == len(t.encode(text, add_special_tokens=False).ids)


def test_token_counts_and_codec(spark, texts):
    t = Tokenizer.from_file(token_counts.tokenizer_path())
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in run(spark, "op4_token_counts")} == {
        i: (len(x.encode()), len(t.encode(x, add_special_tokens=False).ids)) for i, x in texts.items()}
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.model_path())
    ids = {i: sp.encode(x) for i, x in texts.items()}
    assert {r.doc_id: tuple(r)[1:] for r in run(spark, "op8_piece_codec")} == {
        i: (len(e), sha(",".join(map(str, e))), sha(sp.decode(e))) for i, e in ids.items()}


def test_odd_texts_round_trip():
    rng = random.Random(9)
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.model_path())
    t = Tokenizer.from_file(token_counts.tokenizer_path())
    table = piece_codec.piece_table(piece_codec.model_path())
    pieces = list(table.ids)
    for _ in range(3000):
        x = "".join(rng.choice(pieces) if rng.random() < .5 else chr(rng.choice([32, 10, 0x2581, rng.randrange(1, 0x300), rng.randrange(0x3000, 0x3100)]))
                    for _ in range(rng.randint(0, 12)))
        e = sp.encode(x)
        assert table.encode(x) == e and table.decode(e) == sp.decode(e) == table.round_trip(x)[1]
        words = token_counts.pre_tokens(x, token_counts.tokenizer_path())
        assert sum(token_counts.count_pieces(words, token_counts.tokenizer_path())) == len(t.encode(x, add_special_tokens=False).ids)


@pytest.mark.parametrize("dim", [8, 64, 768])
def test_embedding_links_of_planted_vectors(spark, dim):
    """Counts, components and kept rows against all pairs; recall of the hashing is 0.97 or more."""
    share_package(spark)
    rng = np.random.default_rng(dim)
    x = list(rng.normal(size=(300, dim)))
    near = lambda v, cosine: v / np.linalg.norm(v) * cosine + (lambda r: r / np.linalg.norm(r) * math.sqrt(1 - cosine * cosine))(
        (lambda r: r - v * (r @ v) / (v @ v))(rng.normal(size=dim)))
    for k in range(150):
        x.append(near(x[k], rng.uniform(0.951, 0.999)) * rng.uniform(0.1, 9))
    for k in range(20):  # chains, and vectors that are just too far
        x += [near(x[300 + k], 0.96), near(x[k + 200], 0.949)]
    x += [x[k] * 1.0 for k in range(30)]  # copies
    x = np.array(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosines = unit @ unit.T
    linked = cosines >= 0.95
    np.fill_diagonal(linked, False)
    got = {r.vec_id: r for r in embedding_dedup.op3(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    assert len(got) == len(x) and linked.sum() > 300
    found = sum(r.n_links for r in got.values())
    assert all(got[i].n_links <= linked[i].sum() for i in got) and found >= 0.97 * linked.sum()
    if found == linked.sum():
        comp = np.arange(len(x))
        while True:
            new = np.array([min(comp[i], comp[linked[i]].min(initial=len(x))) for i in range(len(x))])
            if (new == comp).all():
                break
            comp = new
        assert [got[i].component_id for i in range(len(x))] == comp.tolist()
        assert [got[i].kept for i in range(len(x))] == (comp == np.arange(len(x))).tolist()


def test_spotsigs(spark, texts):
    ids = sorted(texts)
    got = {r.doc_id: r for r in run(spark, "op9_spotsigs")}
    for k, i in enumerate(ids):
        a, b = texts[i], texts[ids[(k + 1) % len(ids)]]
        e = spotsigs.edited(a, b)
        s, se, sb = (set(spotsigs.signatures(x).tolist()) for x in (a, e, b))
        jac = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
        assert tuple(got[i])[1:] == (len(a), sha(e), spotsigs.as_text(spotsigs.signatures(a)), spotsigs.as_text(spotsigs.signatures(e)), jac(s, se), jac(s, sb))


def test_spotsigs_sets_are_of_one_kind_at_every_size():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    anchors = sorted(spotsigs.ANCHORS)
    like = lambda a, b: spotsigs.likeness(*map(spotsigs.signatures, (a, b)))
    for n_anchors in range(0, 20):  # the number of signatures crosses every small size
        text = [rng.choice(words) for _ in range(200)]
        for at in rng.sample(range(190), n_anchors):
            text[at] = rng.choice(anchors)
        before = " ".join(text)
        assert like(before, before) == 1
        for at in range(0, 200, 7):  # a word or an anchor taken out or put in
            for new in ([], ["other"], ["the"], [text[at], "the"]):
                assert like(before, " ".join(text[:at] + new + text[at + 1:])) > 0.85
    for n in range(2, 12):  # in a short text one edit may change every chain
        text = ["the", "of"] + rng.sample(words, n)
        for at in range(len(text)):
            assert like(" ".join(text), " ".join(text[:at] + ["other"] + text[at + 1:])) > 0
    assert like("?!", "?! word") > 0 and like(" ", "") == 1 and like("", "word") == 0


def test_quality_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in read_table(spark, "/root/testdata/sf0.01", "labels").collect()}
    rows = [r for r in queries.op5_quality(spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in labels]
    right = sum((r.score >= 0.5) == (labels[r.doc_id] == 1) for r in rows) / len(rows)
    assert right > 0.95
    assert quality.features(["", "a b"]).shape == (2, len(quality.FEATURES))


PAGE = ("<html><head><title>t</title></head><body><header>Site</header><nav>Home</nav><div class='cookie-notice'>We use</div>"
        "<article><h1>A &amp; B</h1><p>one <b>tw</b>o<br>three<p>four &lt; five<div class='ad'>buy</div><ul><li>x<li>y</ul>"
        "<section id='comments'><p>nice</p></section><form>f</form></article><aside>s</aside><footer>&copy;</footer></body></html>")


def test_article_text():
    assert [t for t, m, o in html_extract.blocks(PAGE) if m and not o] == ["A & B", "one two three", "four < five", "x", "y"]


def main_of(page):
    return [t for t, m, o in html_extract.blocks(page) if m and not o]


def test_parts_are_named_by_whole_tokens():
    keep = ["<h2 id='social-history'>A</h2>", "<section id='search-methods'>A</section>", "<p class='share-of-market'>A</p>",
            "<div class='notice-period'>A</div>", "<div class='post-content entry'>A</div>", "<header>A</header>", "<span class='ad-free'>A</span>",
            "<div id='main-header'>A</div>", "<p>A</p>", "<a class='external'>A</a>", "<div class=''>A</div>"]
    cut = ["<p class='advert'>A</p>", "<p class='cookie-notice'>A</p>", "<a class='share'>A</a>", "<div id='commentList'>A</div>",
           "<section class='related_posts ads'>A</section>", "<div class='post-comments'>A</div>", "<div hidden>A</div>", "<span class='ad'>A</span>",
           "<div class='site-footer'>A</div>", "<ul class='social-share-buttons'>A</ul>", "<article class='comment'>A</article>",
           "<div style='display: none'>A</div>", "<div role='navigation'>A</div>", "<p class='ad'>A<b>B</b></p>"]
    for part in keep:
        assert main_of(f"<article><p>one</p>{part}<p>two</p></article>") == ["one", "A", "two"], part
    for part in cut:
        assert main_of(f"<article><p>one</p>{part}<p>two</p></article>") == ["one", "two"], part
    assert main_of("<article><p>one <a class='share' href=x>Share <b>this</b></a> two <em>three</em></p></article>") == ["one two three"]
    assert main_of("<article><p class=advert>buy<p>one<p class=ad>buy<div>two</div></article>") == ["one", "two"]


def test_main_parts_inside_other_parts():
    own = "<article><h1>T</h1><p>text</p></article>"
    for more in ("<aside><article>teaser</article></aside>", "<article class='ad sponsored'>buy</article>", "<section id=comments><article>nice</article></section>",
                 "<div class='comments'><article class='comment'><p>nice</p></article></div>", "<article class='comment'><p>nice</p></article>",
                 "<nav><article>link</article></nav>", "<div hidden><main>old</main></div>"):
        assert main_of(f"<body>{own}{more}</body>") == ["T", "text"] == main_of(f"<body>{more}{own}</body>"), more
    assert main_of(f"<body><div class='cookie-notice'>We use{own}</body>") == ["T", "text"]  # left open
    assert main_of("<body><main class='search content'><p>found</p></main></body>") == ["found"]
    assert main_of("<article class='post ad-free'><p>x</p></article>") == ["x"]


def test_pages_without_article_lose_what_their_host_repeats(spark):
    line = "All rights reserved by the people who run this site"
    page = "<body><div>{0}</div><div>{1}</div><p>{2}</p></body>"
    rows = [(k, f"http://h.example.com/{k}", page.format("Welcome to our little site about all things", f"own{k} text{k} here{k}", line)) for k in range(5)]
    rows += [(9, "http://other.example.com/", page.format("Welcome to our little site about all things", "alone", line))]
    got = {r.page_id: r.text for r in html_extract.op1(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"own{k} text{k} here{k}" for k in range(5))
    assert got[9].split("\n")[1] == "alone" and line in got[9]


def test_near_copies_and_shared_passages_of_a_host_are_kept(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    line = "All rights reserved by the people who run this site"
    page = lambda text, tag="div": f"<body><{tag}>{text}</{tag}><p>{line}</p></body>"
    own = [prose(300) for _ in range(3)]
    own += [own[0].replace(own[0].split()[k], "changed", 1) for k in (5, 150, 290, 295)]  # near copies of the first
    quote = prose(30)
    own += [prose(100) + " " + quote + " " + prose(100) for _ in range(3)]  # on 3 of the host's distinct pages
    n = len(own)
    rows = [(k, f"http://h.example.com/{k}", page(t)) for k, t in enumerate(own)]
    rows += [(n + k, f"http://h.example.com/a{k}", page(prose(200), "article")) for k in range(20)]
    two = [prose(300)]
    two += [two[0].replace(two[0].split()[77], "changed", 1)]  # a host of one page and its near copy
    rows += [(100 + k, f"http://two.example.com/{k}", page(t)) for k, t in enumerate(two)]
    got = {r.page_id: r.text for r in html_extract.op1(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    assert len(got) == len(rows)
    assert [got[k] for k in range(n)] == own
    assert [got[100 + k] for k in range(2)] == [f"{t}\n{line}" for t in two]


def test_main_parts_lose_what_their_host_repeats_outside(spark):
    notice = "Our newsletter brings you the best of the week every Friday morning free of charge"
    shared = "Every article of this site opens with the very same words and they are its own"
    own = lambda k: f"own{k} text{k} of{k} this{k} page{k} that{k} nothing{k} repeats{k} anywhere{k}"
    page = "<body><article><p>{0}</p><p>{1}</p><div>{2}</div></article><div>{3}</div></body>"
    rows = [(k, f"http://h.example.com/{k}", page.format(shared, own(k), "the end", notice)) for k in range(6)]
    rows += [(6, "http://h.example.com/6", page.format(shared, own(6), notice, "")),
             (7, "http://h.example.com/7", page.format(shared, f"{own(7)} {notice}", "quoted", "")),
             (8, "http://h.example.com/8", page.format(own(8), "", notice + " and what begins alike stays", "")),
             (9, "http://h.example.com/9", page.format(notice, own(9), "", ""))]  # a paragraph is the article's own
    rows += [(20 + k, f"http://g.example.com/{k}", page.format(own(k), own(k + 50), notice, "")) for k in range(9)]  # never outside
    got = {r.page_id: r.text for r in html_extract.op1(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {**{k: f"{shared}\n{own(k)}\nthe end" for k in range(6)}, 6: f"{shared}\n{own(6)}",
                   7: f"{shared}\n{own(7)} {notice}\nquoted", 8: f"{own(8)}\n{notice} and what begins alike stays", 9: f"{notice}\n{own(9)}",
                   **{20 + k: f"{own(k)}\n{own(k + 50)}\n{notice}" for k in range(9)}}


def slow_main_texts(rows):
    """Main text of pages without a main part, every page held against every other of its host."""
    hosts = {}
    for k, url, page in rows:
        found = html_extract.blocks(page or "")
        hosts.setdefault(url.split("://")[1].split("/")[0], []).append((k, [t for t, _, _ in found], [o for _, _, o in found]))
    out = {}
    for pages in hosts.values():
        marks = [np.frombuffer(html_extract.sketch(" ".join(b).split()), "<u2") for _, b, _ in pages]
        cls = list(range(len(pages)))
        for i in range(len(pages)):
            for j in range(i):
                if len(marks[i]) and len(marks[j]) and (marks[i] == marks[j]).mean() >= html_extract.NEAR:
                    cls = [cls[j] if c == cls[i] else c for c in cls]
        streams = [" ".join(b).split() for _, b, _ in pages]
        on, width = {}, html_extract.RUN
        for c, tokens in zip(cls, streams):
            for k in range(len(tokens) - width + 1):
                on.setdefault(tuple(tokens[k:k + width]), set()).add(c)
        of = len({c for c, m in zip(cls, marks) if len(m)})
        for (page, texts, other), tokens in zip(pages, streams):
            gone = set()
            for k in range(len(tokens) - width + 1):
                n = len(on[tuple(tokens[k:k + width])])
                if n >= html_extract.LEAST and n >= html_extract.SHARE * of:
                    gone |= set(range(k, k + width))
            kept, k = [], 0
            for text, o in zip(texts, other):
                left = [t for i, t in enumerate(text.split(), k) if i not in gone]
                k += len(text.split())
                kept += [" ".join(left)] if left and not o else []
            out[page] = "\n".join(kept)
    return out


def test_suffix_array_of_hosts_equals_plain_counts(spark):
    rows = [(r.page_id, r.url, re.sub(r"<(/?)(article|main)\b", r"<\1div", r.html or ""))
            for r in read_table(spark, SF, "pages").where("url like '%://%'").collect()]
    line = "this line of more than eight words stands on every third page of the one host " + "x" * 100_000
    rows += [(10_000 + k, "http://one.example.com/", f"<div>{'y' * 40} {line if k % 3 == 0 else ''} {' '.join(f'v{k}w{i}' for i in range(40))}</div>") for k in range(90)]
    rows += [(20_000 + k, "http://one.example.com/", rows[-1][2]) for k in range(60)]  # copies of one page
    got = {r.page_id: r.text for r in html_extract.op1(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    expected = slow_main_texts(rows)
    assert got == expected
    assert line not in got[10_000] and "v3w0 " in got[10_003]


def test_repeats_that_reach_over_ranges_and_batches():
    import pyarrow as pa

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))],
                                          ["host", "suffix", "class"])

    entries = sorted([("h", "a", c) for c in (1, 1, 2, 3)] + [("h", "b", c) for c in (1, 2)] + [("h", "c", 5)] + [("i", "a", c) for c in range(9)])
    expected = {("h", "a"): 3, ("i", "a"): 9}
    for cut in range(1, len(entries)):
        if entries[cut - 1] == entries[cut]:
            continue  # ranges part only between different entries
        for step in (1, 3, 100):
            total = Counter()
            for part in (entries[:cut], entries[cut:]):
                for out in html_extract._repeats(batch(part[k:k + step]) for k in range(0, len(part), step)):
                    for host, head, n in zip(*(out.column(k).to_pylist() for k in range(3))):
                        total[host, head] += n
            assert {k: n for k, n in total.items() if n >= html_extract.LEAST} == {(h, html_extract._head(h, s)): n for (h, s), n in expected.items()}


def slow_url_scores(urls):
    """Scores of ``(host, path)`` with every word in one dictionary."""
    uni = Counter(url_filter.SEEDS)
    for h in {h for h, _ in urls}:
        uni.update({w for x in h.split(".") if "-" in x for w in re.findall("[a-z]{2,}", x)})
    for _, p in urls:
        uni.update(re.findall("[a-z]{2,}", p.lower()))
    total = sum(uni.values())
    cost = {w: math.log(total / n) for w, n in uni.items()}
    split = lru_cache(maxsize=None)(lambda x: url_filter.segment(x, cost, math.log(total)))
    words = []
    for h, p in urls:
        in_host = [w for x in url_filter._LABEL.findall(h) for w in (["0"] if x.isdigit() else split(x))]
        words.append((in_host + ["/0" if w.isdigit() else "/" + w for w in url_filter._LABEL.findall(p.lower())], not url_filter.SEEDS.isdisjoint(in_host)))
    n = {True: Counter(), False: Counter()}
    for w, bad in words:
        n[bad].update(w)
    b, g = (n[x].total() + len(n[True] | n[False]) for x in (True, False))
    return [sum(math.log((n[True][x] + 1) / b) - math.log((n[False][x] + 1) / g) for x in w) if n[True] else 0.0 for w, _ in words]


def test_url_scores_keep_every_word(spark):
    rng = random.Random(5)
    rows = [("blog-news.example.com", "/a/b"), ("www.casinobet.example", "/win/2020"), ("my-poker.example", "/win"), ("é-ü.example", "/Ü/x"), ("", ""), ("12.34", "/")] * 3
    rows += [(f"h{rng.randrange(60)}.blognewswin.example", "/" + "/".join("w" + "".join(rng.choices("abcdefghij", k=6)) for _ in range(60))) for _ in range(4000)]
    rows += rows[30:60]
    assert len({w for _, p in rows for w in p.split("/")}) > 200_000  # more words than one dictionary once held
    df = spark.createDataFrame([(k, f"http://{h}{p}") for k, (h, p) in enumerate(rows)], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(df, rules=()).collect()}
    want = slow_url_scores(rows)
    assert len(got) == len(rows)
    for k, x in enumerate(want):
        assert abs(got[k].score - x) < 1e-6 and (got[k].host, got[k].path) == rows[k]
        assert got[k].verdict == ("block" if x > 0 else "allow")
    assert max(want) > 0 > min(want)


def test_known_words_of_any_length_stay_whole(spark):
    rng = random.Random(12)
    long = "pneumonoultramicroscopicsilicovolcanoconiosis"
    counts = spark.createDataFrame([(long, 4), ("blog", 9), ("my", 9)], "w string, n long")
    names = ["my" + long + "blog", long, "q" * 40, "my" * 50_000]
    labels = spark.createDataFrame([(str(k).encode(), x) for k, x in enumerate(names)], "label_key binary, label string")
    got = {names[int(r.label_key)]: {x.w: x.times for x in r.words} for r in url_filter.split_labels(labels, counts).collect()}
    assert got == {names[0]: {"my": 1, long: 1, "blog": 1}, long: {long: 1}, "q" * 40: {"q" * 40: 1}, names[3]: {"my": 50_000}}
    for _ in range(300):  # every split of a name, against the cheapest one
        name = "".join(rng.choices("ab", k=rng.randint(1, 9)))
        cost = {"".join(rng.choices("ab", k=rng.randint(1, 5))): rng.uniform(1, 6) for _ in range(6)}
        price = lambda ws: sum(cost.get(w, 6 + 2.3 * len(w)) for w in ws)
        splits = [[]]
        for c in name:
            splits = [s + [c] for s in splits] + [s[:-1] + [s[-1] + c] for s in splits if s]
        assert abs(price(url_filter.segment(name, cost, 6)) - min(map(price, splits))) < 1e-9
