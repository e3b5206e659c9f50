"""Operators against brute force, exact round trips and held-out labels."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tidelog.llm import ann, bpe, decontam, htmltext, langid, quality, sharding, simhash, warc
from tidelog.llm.common import connected
from tidelog.llm.queries import RANKS

TABLES = "/root/testdata/sf0.01"
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "two words"), (None, "two words"), (5, "x" * 300_000),
    (6, "\n".join(["the same line again and again, as it was before"] * 200)), (7, "İß  \x1c​　 日本語 नमस्ते 🙂🙂"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture()
def odd(spark):
    """Odd texts, and columns with names that the operators use themselves."""
    rows = [(i, t, "en", "h.example.org", "r", 1, "c", "k") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, host string, row string, id int, chunks string, key string")


@pytest.fixture()
def empty(odd):
    return odd.limit(0)


# connected classes


def test_connected(spark):
    rng = np.random.default_rng(1)
    for n, m in ((60, 40), (200, 150), (50, 400)):
        links = [(int(a), int(b)) for a, b in rng.integers(0, n, (m, 2))] + [(1000 + k, 1001 + k) for k in range(30)] + [(2000, 2001 + k) for k in range(50)]
        found = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in links:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        assert found == {x: find(x) for x in {y for a, b in links if a != b for y in (a, b)}}


# SimHash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_classes(rows, bits=3):
    """(id, fingerprint) to the smallest id reached."""
    prints = sorted({f for _, f in rows})
    table = np.array(prints, np.uint64)
    group = list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for k, f in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(table ^ np.uint64(f)) <= bits).tolist():
            a, b = find(k), find(j)
            group[max(a, b)] = min(a, b)
    least = defaultdict(list)
    place = {f: k for k, f in enumerate(prints)}
    for i, f in rows:
        least[find(place[f])].append(i)
    return {f: min((i for i in least[find(place[f])] if i is not None), default=None) for f in prints}


def test_simhash_equals_brute_force(docs, texts):
    found = simhash.near_duplicates(docs).collect()
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    classes = brute_classes(list(prints.items()))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {i: (f"{f:016x}", classes[f]) for i, f in prints.items()}


def test_simhash_on_crowded_cells(spark):
    """Chains and balls of close fingerprints, with parts so small that cells are cut."""
    rng = np.random.default_rng(5)
    values = {0}
    for _ in range(6):
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(60):
            centre ^= 1 << int(rng.integers(0, 64))
            values.add(centre ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    marked = spark.createDataFrame([(k, v) for k, v in enumerate(signed)], "id long, fp long")
    links = simhash.close_links(marked.select("fp"), part=7).collect()
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 3 for r in links)
    found = {r.fp: r.component for r in simhash.component_of(marked).collect()}
    classes = brute_classes([(k, v & (1 << 64) - 1) for k, v in enumerate(signed)])
    assert found == {v: classes[v & (1 << 64) - 1] for v in signed}


def test_simhash_odd_rows(odd, empty):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == len(ODD)
    assert [r.component_id for r in found if r.fingerprint == "0" * 16] == [1, 1, 1]
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    classes = brute_classes([(i, brute_fingerprint(t)) for i, t in ODD])
    assert len(rows) == len({classes[brute_fingerprint(t)] if classes[brute_fingerprint(t)] is not None else brute_fingerprint(t) for _, t in ODD})
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


# byte-level BPE


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.read_vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_encoding(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark, docs, odd, vocabulary, reference_encoding):
    every = docs.select("text").union(odd.where("length(text) < 100000 or text is null").select("text"))
    every = every.withColumn("ids", F.lit("replaced")).withColumn("__texts", F.lit(1))
    coded = bpe.decode(bpe.encode_and_decode(every, vocabulary), vocabulary, decoded="back")
    assert bpe.encode(every, vocabulary).columns == ["text", "__texts", "ids"]
    for r in coded.withColumn("joined", bpe.joined_ids(F.col("ids"))).collect():
        ids = reference_encoding.encode_ordinary(r.text or "")
        assert r.ids == ids and bytes(r.back) == bytes(r.decoded) == (r.text or "").encode() and r.joined == ",".join(map(str, ids))


def test_bpe_cuts_as_tiktoken_does(vocabulary, reference_encoding):
    """Every code point between letters and blanks."""
    for first in range(0, 0x11000, 64):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1" for c in range(first, first + 64) if not 0xD800 <= c < 0xE000)
        assert vocabulary.encode(text) == reference_encoding.encode_ordinary(text), hex(first)


def test_bpe_long_match_is_merged_in_reasonable_time(vocabulary, reference_encoding):
    text = "abcde" * 4000
    assert vocabulary.encode(text) == reference_encoding.encode_ordinary(text)


# sharding


def test_best_fit_equals_a_plain_list():
    rng = np.random.default_rng(3)
    for _ in range(40):
        sizes = sorted(rng.integers(1, 100, int(rng.integers(1, 200))).tolist(), reverse=True)
        room, plain = [], []
        for s in sizes:
            fit = min(((r, k) for k, r in enumerate(room) if r >= s), default=None)
            if fit is None:
                room.append(max(150, s))
                fit = (0, len(room) - 1)
            room[fit[1]] -= s
            plain.append(fit[1])
        assert sharding.best_fit(sizes, 150) == plain


def check_shards(rows, texts_of, shards):
    total, slots, homes = defaultdict(int), defaultdict(list), {}
    for r in rows:
        text = texts_of(r) or ""
        assert r.size == len(text.encode()) + 16 and r.text_crc32 == zlib.crc32(text.encode())
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert homes.setdefault(text, r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(total) <= set(range(shards))
    return total


def test_shards_are_even_and_whole(docs, texts):
    rows = sharding.shard(docs, shards=8).collect()
    total = check_shards(rows, lambda r: texts[r.doc_id], 8)
    assert len(rows) == len(texts) and max(total.values()) < 1.01 * sum(total.values()) / 8


def test_a_large_group_has_a_shard_to_itself(spark):
    rows = [(k, "copy" * 50) for k in range(500)] + [(1000 + k, f"text {k} " * 5) for k in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    total = check_shards(sharding.shard(frame, shards=10).collect(), lambda r: dict(rows)[r.doc_id], 10)
    sizes = sorted(total.values())
    assert sizes[-1] == 500 * 216 and sizes[-2] < 1.02 * (sizes[0] + 1)


def test_shard_odd_rows(odd, empty):
    rows = sharding.shard(odd).collect()
    assert len(rows) == len(ODD) and sum(r.size for r in rows) == sum(len((t or "").encode()) + 16 for _, t in ODD)
    assert sharding.shard(empty).count() == 0


# WARC


def test_warc_equals_sql(spark, tmp_path):
    pages = spark.read.parquet(f"{TABLES}/pages.parquet")
    more = spark.createDataFrame(
        [(-1, None, None), (-2, "http://a\r\nb", ""), (None, None, "n" * 200), (7001, "u", "n" * 200), (7000, "u", "n" * 200), (7002, "u", "n" * 99), (7003, "u", "n" * 99), (7004, "u", "WARC/1.1\r\n\r\n" * 40)],
        "page_id long, url string, html string",
    )
    pages = pages.union(more)
    pages.write.parquet(str(tmp_path / "pages"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    from tidelog.llm.queries import oracle_sql

    wanted = db.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({oracle_sql()['op5_warc']})").fetchall()
    found = [tuple(r) for r in warc.archive_pages(pages, str(tmp_path / "archive")).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(found, key=key) == sorted(wanted, key=key)


def test_warc_pushes_down_and_passes_over_payloads(spark, tmp_path):
    rows = [("response" if k % 3 else "metadata", f"<r:{k}>", f"http://h{k % 5}/{k}", "2020-01-01T00:00:00Z", None, None, None, bytes([k % 256]) * k) for k in range(400)]
    frame = spark.createDataFrame(rows, "record_type string, record_id string, target_uri string, warc_date string, payload_digest string, payload_bytes long, refers_to string, payload binary")
    path = f"file://{tmp_path}/w"
    warc.write_warc(frame, path)
    read = warc.read_warc(spark, path)
    assert {(r.record_id, bytes(r.payload)) for r in read.collect()} == {(r[1], r[7]) for r in rows}
    some = read.where("record_type = 'metadata' and target_uri like 'http://h2/%'")
    assert {r.record_id for r in some.collect()} == {r[1] for r in rows if r[0] == "metadata" and r[2].startswith("http://h2/")}
    assert not re.search(r"\bFilter \(", some._jdf.queryExecution().executedPlan().toString())
    assert [r.payload for r in warc.read_warc(spark, path, payload=False).where("record_type = 'metadata'").collect()] == [None] * 134
    warc.write_warc(frame.limit(3), path)
    assert warc.read_warc(spark, path).count() == 403


def test_warc_damage_is_an_error(spark, tmp_path):
    (tmp_path / "bad.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort")
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_warc(spark, f"file://{tmp_path}").collect()


# decontamination


def brute_distance(item, text):
    prev = list(range(len(item) + 1))
    best = prev[-1]
    for w in text:
        now = [0]
        for j, x in enumerate(item, 1):
            now.append(min(prev[j] + 1, now[j - 1] + 1, prev[j - 1] + (x != w)))
        best, prev = min(best, now[-1]), now
    return best


def test_exact_passages_are_all_found(spark, docs, texts):
    benchmark = spark.read.parquet(f"{TABLES}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    found = decontam.find_leaks(docs, benchmark).collect()
    exact = {(i, k) for i, t in texts.items() for k, x in items.items() if x in t}
    assert exact <= {(r.doc_id, r.item_id) for r in found}
    for r in found:
        item = decontam.words_of(items[r.item_id])
        assert r.edits <= 0.2 * len(item) and brute_distance(item, decontam.words_of(texts[r.doc_id])) == r.edits
        assert brute_distance(item, decontam.words_of(texts[r.doc_id][r.begin : r.end])) == r.edits
    clean = decontam.decontaminate(docs, benchmark)
    assert {r.doc_id for r in clean.select("doc_id").collect()} == set(texts) - {r.doc_id for r in found}


def test_edited_passages_reach_the_recall(texts):
    rng = np.random.default_rng(8)
    words = sorted({w for t in list(texts.values())[:200] for w in decontam.words_of(t)})
    items = [" ".join(rng.choice(words, int(n))) for n in rng.integers(12, 60, 100)]
    finder, hit, wrong = decontam.Finder(items), 0, 0
    cases = []
    for k in range(300):
        item = items[k % 100].split()
        for _ in range(int(rng.integers(0, finder.allowed(len(item)) + 1))):
            at, kind = int(rng.integers(0, len(item))), int(rng.integers(0, 3))
            item[at : at + 1] = [[str(rng.choice(words))], [item[at], str(rng.choice(words))], []][kind]
        around = [str(x) for x in rng.choice(words, 80)]
        cases.append(" ".join([*around[:40], *item, *around[40:]]))
    for k, hits in enumerate(finder.find(cases)):
        hit += any(h["item"] == k % 100 for h in hits)
        wrong += sum(brute_distance(finder.items[h["item"]], decontam.words_of(cases[k])) > finder.allowed(len(finder.items[h["item"]])) for h in hits)
    assert hit >= 0.95 * 300 and wrong == 0


def test_decontamination_odd_rows(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "One!"), (5, "two words"), (None, "日本語")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.find_leaks(odd, benchmark).collect()}
    assert found == {(4, 3), (4, 4), (None, 5), (7, None)}
    assert decontam.find_leaks(empty, benchmark).count() == 0
    assert decontam.find_leaks(odd, benchmark.limit(0)).count() == 0
    assert decontam.decontaminate(odd, benchmark.limit(0)).count() == len(ODD)


def test_short_and_long_items_are_found(spark):
    """Exact copies of two-word items, and 400-word items at the largest distance; item ids may be text."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(3000)]
    some = lambda n: [str(x) for x in rng.choice(words, n)]
    short = [" ".join(some(2)) for _ in range(150)]
    rows = [(k, " ".join([*some(20), x, *some(20)])) for k, x in enumerate(short)]
    benchmark = spark.createDataFrame([(f"item {k}", x) for k, x in enumerate(short)], "item_id string, text string")
    found = decontam.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark)
    assert {(k, f"item {k}") for k in range(150)} <= {(r.doc_id, r.item_id) for r in found.collect()}
    items = [some(400) for _ in range(40)]
    finder, cases = decontam.Finder([" ".join(x) for x in items]), []
    for item in items:
        item = list(item)
        for _ in range(80):
            at, kind = int(rng.integers(0, len(item))), int(rng.integers(0, 3))
            item[at : at + 1] = [some(1), [item[at], *some(1)], []][kind]
        cases.append(" ".join([*some(50), *item, *some(50)]))
    hits = sum(any(h["item"] == k for h in found) for k, found in enumerate(finder.find(cases)))
    assert hits >= 0.9 * 40


# nearest neighbours


def brute_nearest(rows, k=20, step=20):
    ids = np.array([i for i, _ in rows])
    table = np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if i % step == 0:
            score = table @ np.array(v, float)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_recall_of_nearest(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.select("vec_id", "embedding").collect()]
    wanted = brute_nearest(rows)
    found = defaultdict(dict)
    for r in ann.nearest(frame).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    assert set(found) == set(wanted)
    hits = 0
    for i, listed in wanted.items():
        got = [found[i][k] for k in sorted(found[i])]
        assert sorted(found[i]) == list(range(1, len(listed) + 1))
        scores = dict(got)
        assert [x for x, _ in got] == [x for x, _ in sorted(got, key=lambda x: (-x[1], x[0]))]
        hits += sum(x in scores and abs(scores[x] - s) < 1e-9 for x, s in listed)
    assert hits >= 0.9 * sum(map(len, wanted.values()))


def test_nearest_with_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.standard_normal(6).round(3).tolist()) for k in range(300)] + [(1000 + k, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for k in range(100)]
    bad = [(500, None), (520, [0.0] * 6), (540, [float("nan")] * 6), (560, [1.0, None, 0, 0, 0, 0]), (580, [float("inf")] * 6), (600, []), (620, [1.0, 2.0]), (None, rows[0][1]), (0, rows[0][1])]
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in rows + bad], "vec_id long, embedding array<double>, key string")
    wanted = brute_nearest(rows)
    found = defaultdict(list)
    for r in sorted(ann.nearest(frame, confidence=0.999999).collect(), key=lambda r: r.rank):
        found[r.query_id].append((r.vec_id, r.score))
    assert {i: [x for x, _ in v] for i, v in found.items()} == {i: [x for x, _ in v] for i, v in wanted.items()}
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(few).orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.0)]
    assert ann.nearest(few.limit(0)).count() == 0


# html


PAGE = (
    '<!DOCTYPE html><html lang="en"><head><title>T{0}</title><style>p{{}}</style><script>var a="</p>";</script></head><body><header><h1>Site</h1></header>'
    '<nav><ul><li><a href="/a">Home {0}</a></li></ul></nav><div class="cookie-notice">We use cookies</div>{1}'
    '<aside>Side {0}</aside><div class="comments"><p>Nice {0}!</p></div><form><input><p>Send {0}</p></form><footer>&copy; Site {0}</footer></body></html>'
)


def pages_of(spark, bodies):
    rows = [(k, f"http://h.example.org/{k}", PAGE.format(k, b)) for k, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_html_article(spark):
    bodies = [f"<article><h1>Title {k}</h1><p>One &amp;\n two<b>{k}</b> x<br><p>Three &lt; four&nbsp;five<div class=ad>Buy</div></article>" for k in range(6)]
    found = htmltext.extract(pages_of(spark, bodies), F.lit("h")).collect()
    assert {r.page_id: r.text for r in found} == {k: f"Title {k} One & two{k} x Three < four five" for k in range(6)}


def test_html_by_template_alone(spark):
    """Without an article the slots of the deduced template decide: what never changes, and lists of links, go."""
    bodies = [
        f'<div id=top>Always the same words here on this site</div><div id=l><a href=x>Link {k}</a> <a href=y>Other {k}</a></div>'
        f"<div id=content><p>{' '.join(f'word{k}x{j}' for j in range(40))}</p></div>"
        for k in range(8)
    ]
    found = htmltext.extract(pages_of(spark, bodies), F.lit("h")).collect()
    assert {r.page_id: r.text for r in found} == {k: " ".join(f"word{k}x{j}" for j in range(40)) for k in range(8)}


def test_html_template_decides_in_articles(spark):
    """What is the same on all pages of a host goes, whatever it is called; short text that changes stays."""
    for open_, close in (("<article>", "</article>"), ("<div id=c>", "</div>")):
        bodies = [f"{open_}<h1>Title {k}</h1><div class=b>Same words on all pages here</div><p>{' '.join(f'word{k}x{j}' for j in range(60))}</p>{close}" for k in range(6)]
        found = htmltext.extract(pages_of(spark, bodies), F.lit("h")).collect()
        assert {r.page_id: r.text for r in found} == {k: f"Title {k} " + " ".join(f"word{k}x{j}" for j in range(60)) for k in range(6)}


def test_html_copies_keep_their_text(spark):
    for open_, close in (("<article>", "</article>"), ("<div id=c>", "</div>")):
        found = htmltext.extract(pages_of(spark, [f"{open_}<h1>Title</h1><p>The same article.</p>{close}"] * 3), F.lit("h")).collect()
        assert [r.text for r in found] == ["Title The same article."] * 3


def test_html_signatures_find_equal_vectors(spark):
    """Tokens share a class exactly if their counts agree on all pages."""
    pages = pages_of(spark, [f"<div id=a>{'<section><i>x</i></section><dl></dl>' * (k % 3)}</div>{'<table></table>' * (k % 2)}" for k in range(12)])
    found = {r.token & (1 << 64) - 1 for s in htmltext.deduce_templates(pages, F.lit("h")).collect() for r in s.slots}
    vectors = defaultdict(dict)
    for r in pages.collect():
        for token, cell in htmltext.page_tokens(r.html).items():
            vectors[token][r.page_id] = cell[0]
    classes = defaultdict(list)
    for token, v in vectors.items():
        classes[tuple(sorted(v.items()))].append(token)
    once = tuple((k, 1) for k in range(12))
    wanted = {t for v, ts in classes.items() for t in ts if len(v) >= 0.3 * 12 and (len(ts) > 1 or v == once)}
    assert found == wanted and len(wanted) < len(vectors)


def test_html_odd_pages(spark):
    odd = [None, "", "   ", "plain < text & more &eacute;", "<p>a<p>b", "<article>", "<article>x</article", '<div title="un>closed', "<!-- x", "<script>x", "<p>" + "long " * 50_000]
    frame = spark.createDataFrame([(k, None if k % 2 else "http://q/", h, "t", "r") for k, h in enumerate(odd)], "page_id long, url string, html string, text string, row string")
    _, host = langid.page_evidence(F.col("html"), F.col("url"))
    found = {r.page_id: r.text for r in htmltext.extract(frame, host).collect()}
    assert [found[k] for k in range(7)] == ["", "", "", "plain < text & more é", "a b", "", "x</article"] or found[6] == "x"
    assert found[10] == ("long " * 50_000).strip() and found[8] == "" and found[9] == ""
    assert htmltext.extract(frame.limit(0), host).count() == 0


def extracted(spark, htmls):
    pages = spark.createDataFrame([(k, x) for k, x in enumerate(htmls)], "page_id long, html string")
    return {r.page_id: r.text for r in htmltext.extract(pages, F.lit("h")).collect()}


def test_html_names_do_not_take_articles_away(spark):
    body = "<p>First of it.</p><p>And the rest.</p>"
    layouts = [
        f'<div class="layout has-sidebar"><article>{body}</article><div class="sidebar">Menu</div></div>',
        f'<article class="post comments-open">{body}</article><section class="comments"><article class="comment">Nice!</article></section>',
        f'<div id="page" class="no-ads"><article>{body}</article></div><div class="site-footer">Imprint</div>',
        f'<div class="overlay"><main>{body}</main></div><div id="related"><article>Elsewhere</article></div>',
        f'<article>{body}<div class="share share-buttons">Tweet</div></article>',
    ]
    for layout in layouts:
        assert extracted(spark, [f"<html><body>{layout}</body></html>"]) == {0: "First of it. And the rest."}
    voiced = '<article><p>First of it.</p><div class="share-of-voice">All of it.</div></article>'
    assert extracted(spark, [voiced]) == {0: "First of it. All of it."}


def test_html_paragraph_of_two_of_three_pages_stays(spark):
    pages = [f"<html><body><article><h1>Title {k}</h1><p>Own text {k}.</p>{'<div>The same on both.</div>' if k < 2 else ''}</article></body></html>" for k in range(3)]
    assert extracted(spark, pages) == {k: f"Title {k} Own text {k}." + (" The same on both." if k < 2 else "") for k in range(3)}


# quality


def test_quality_on_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit_quality(docs, rows=3000, labels=labels)
    rows = quality.classify(docs, model).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality and not r.toxic]
    assert sum(r.keep for r in good) >= 0.99 * len(good)
    assert sum(not r.keep for r in rows if not r.quality) >= 0.95 * sum(not r.quality for r in rows)
    assert sum(not r.keep for r in rows if r.toxic) >= 0.99 * sum(r.toxic for r in rows)
    # the scorer alone, which never sees a vote
    assert sum((r.score > 0.5) == bool(r.quality) for r in rows) >= 0.95 * len(rows)


@pytest.mark.parametrize("seed", [42, 1, 2])
def test_toxicity_on_held_out_labels(spark, seed):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    third = F.pmod(F.xxhash64("doc_id") if seed == 42 else F.xxhash64("doc_id", F.lit(seed)), F.lit(3)) == 0
    model = quality.fit_quality(docs, rows=3000, labels=labels.where(~third))
    rows = quality.classify(docs, model).join(labels.where(third), "doc_id").collect()
    toxic, good = [r for r in rows if r.toxic], [r for r in rows if r.quality and not r.toxic]
    assert sum(not r.keep for r in toxic) >= 0.95 * len(toxic)
    assert sum(r.keep for r in good) >= 0.99 * len(good)


def test_marks_odd_labels(spark, odd, empty):
    """Null keys and labels, repeated keys, keys without documents, and no labels at all."""
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, 1), (2, None), (None, 1), (4, 1), (4, 0), (99, 0), (6, 0)], "doc_id long, toxic int")
    for table in (odd, empty):
        for labels in (none, some):
            assert quality.learn_marks(table, labels) == {}
    texts = [(k, f"plain words number{k} " + ("badwordish stay" if k % 5 == 0 else "stay")) for k in range(200)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    marks = quality.learn_marks(frame, frame.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic")))
    assert set(marks) == {"badwordish", "badwo*", "badwor*", "badword*", "badwordi*"} and min(marks.values()) > 4


def test_labels_are_recovered():
    """Expectation-maximisation finds planted accuracies."""
    rng = np.random.default_rng(6)
    truth = rng.random(60_000) < 0.8
    right = [0.95, 0.9, 0.85, 0.8, 0.7]
    votes = np.stack([np.where(rng.random(len(truth)) < 0.3, 0, np.where((rng.random(len(truth)) < a) == truth, 1, -1)) for a in right], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    labels = quality.fit_labels(patterns, counts)
    assert np.abs(labels.accuracies() - right).max() < 0.02 and abs(labels.prior - 0.8) < 0.02


def test_quality_odd_rows(odd, empty, docs):
    model = quality.fit_quality(docs.limit(300), rows=300)
    found = quality.classify(odd.withColumn("keep", F.lit("x")), model)
    assert found.columns == [*odd.columns, "posterior", "score", "not_toxic", "toxic_score", "keep"]
    rows = found.collect()
    assert len(rows) == len(ODD) and not any(r.keep for r in rows if not (r.text or "").strip())
    assert quality.classify(empty, model).count() == 0
    nothing = quality.fit_quality(empty)
    assert quality.classify(odd, nothing).count() == len(ODD)


# names of the input


def test_columns_with_names_of_the_operators(spark, docs):
    """Columns named like helpers pass through unchanged."""
    few = docs.limit(50).withColumns({n: F.lit("mine") for n in ("__source", "__host", "__declared", "declared", "domain", "suffix", "ll")})
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    for found in (bpe.encode_and_decode(few, vocabulary), langid.identify(few, langid.fit_text_model(docs, "text", "lang"), declared=F.col("lang"), host=F.col("source"))):
        rows = found.collect()
        assert len(rows) == 50 and all(r["__source"] == r["__host"] == r["__declared"] == r["suffix"] == "mine" for r in rows)


def test_languages_do_not_depend_on_the_size_of_the_table(spark, docs):
    """A label with few of very many rows is learnt, and a large group of copies counts once."""
    base = docs.where("lang is not null and text <> ''")
    rare = base.where("lang = 'de'").limit(20)
    many = base.where("lang = 'en'").crossJoin(spark.range(20)).withColumn("text", F.concat("text", F.lit(" "), F.col("id").cast("string"))).drop("id")
    copies = spark.range(3000).select(F.lit("one and the same text").alias("text"), F.lit("en").alias("lang"))
    table = rare.select("text", "lang").union(many.select("text", "lang")).union(copies)
    model = langid.fit_text_model(table, "text", "lang", rows=200)
    assert model.languages == ["de", "en", "und"]


# language ID


def test_language_on_held_out_documents(docs):
    half = F.pmod("doc_id", F.lit(2)) == 0
    model = langid.fit_text_model(docs.where(half), "text", "lang")
    found = langid.identify(docs.where(~half).withColumn("detected", F.lit("x")), model).collect()
    assert sum(r.detected == r.lang for r in found) >= 0.98 * len(found) and sum(r.accepted for r in found) >= 0.99 * len(found)


def test_other_evidence_decides_where_text_is_weak(spark, docs):
    model = langid.fit_text_model(docs, "text", "lang")
    rows = [(k, "s", "x.de", "de") for k in range(3)] + [(10 + k, r.text, "x.de", "de") for k, r in enumerate(docs.where("lang = 'de'").limit(60).collect())]
    rows += [(100 + k, r.text, "y.fr", "fr") for k, r in enumerate(docs.where("lang = 'fr'").limit(60).collect())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, host string, declared string")
    found = langid.identify(frame, model, declared=F.col("declared"), host=F.col("host")).where("doc_id < 3").collect()
    assert {r.detected for r in found} == {"de"} and min(r.posterior for r in found) > 0.9


def test_language_odd_rows(spark, odd, empty, docs):
    model = langid.fit_text_model(docs, "text", "lang")
    found = langid.identify(odd, model, declared=F.col("lang"), host=F.col("host"))
    assert found.columns == [*odd.columns, "detected", "posterior", "accepted"]
    rows = found.collect()
    assert len(rows) == len(ODD)
    assert all(r.detected == "und" and r.posterior == 0 and not r.accepted for r in rows if not (r.text or "").strip())
    strange = spark.createDataFrame([("Съешь же ещё этих мягких французских булок, да выпей чаю",)], "text string")
    assert langid.identify(strange, model).first().accepted is False
    assert langid.identify(empty, model).count() == 0
    nothing = langid.fit_text_model(empty, "text", "lang")
    assert langid.identify(odd, nothing).where("accepted").count() == 0


def test_page_evidence(spark):
    rows = [('<HTML class=x LANG="de-AT">', "https://u@www.Example.co.uk:80/x"), ("<html>", "nonsense"), (None, None)]
    declared, host = langid.page_evidence(F.col("html"), F.col("url"))
    found = spark.createDataFrame(rows, "html string, url string").select(declared.alias("d"), host.alias("h")).collect()
    assert [tuple(r) for r in found] == [("de", "www.example.co.uk"), (None, None), (None, None)]




def test_labellers_vote_once_on_each_row(spark, monkeypatch):
    """What is fitted and classified together is what both give one after the other; the votes are counted from storage."""
    docs = spark.createDataFrame([*ODD, *((1000 + k, f"some words of text number {k} that go on. And on {'!' * (k % 7)}") for k in range(200))], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 7 == 6).cast("int").alias("toxic")).where("doc_id >= 1000")
    one_by_one = quality.classify(docs, quality.fit_quality(docs, labels=labels))
    plans, keep = [], quality.stored

    def noted(frame, label):
        plans.append((label, frame._jdf.queryExecution().executedPlan().toString()))
        return keep(frame, label)

    monkeypatch.setattr(quality, "stored", noted)
    together = quality.fit_and_classify(docs, labels=labels)
    assert together.columns == one_by_one.columns
    assert sorted(map(str, together.collect())) == sorted(map(str, one_by_one.collect()))
    assert [label for label, plan in plans if "Python" in plan and label in ("voted", "votes")] == ["voted"]
    assert together._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_remembered_weights_are_those_of_the_marks(monkeypatch):
    marks = {"abcde*": 2.0, "abcdefg": 3.0, "xyz": 1.5}
    monkeypatch.setattr(quality, "REMEMBERED", 2)
    weights = quality.Weights(marks)
    words = ["abcdefg", "abcdex", "xyz", "none", "abcde", "y" * 1000, "abcdefg"]
    assert [weights[w] for w in words] == [3.0, 2.0, 1.5, 0.0, 0.0, 0.0, 3.0] and len(weights) <= 2
    text = "abcdefg abcdex xyz none"
    assert quality.votes_of(text, marks) == quality.votes_of(text, marks, weights=weights)
